"""Readers: point tables, positional CSV and raw lines, zone tables, run records; test-table fixtures."""
