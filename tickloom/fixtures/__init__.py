"""Inputs derived from the driver's tables, for tests and oracle queries."""
