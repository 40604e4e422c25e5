"""Column functions: Catalyst expressions only, no Python in the row path."""
