"""Queries over the given tables, each with its DuckDB oracle where SQL can express it."""
