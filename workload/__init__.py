"""Registered queries and the DuckDB statements they are checked against."""
