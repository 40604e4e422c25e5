"""Tick-by-tick message analytics on Spark."""
