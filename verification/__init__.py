"""Queries over the driver tables, each paired with an independent DuckDB query."""
