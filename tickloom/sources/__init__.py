"""Scans: capture files, contract files, listings and ledgers."""
