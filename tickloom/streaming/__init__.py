"""Incremental forms of the ingest."""
