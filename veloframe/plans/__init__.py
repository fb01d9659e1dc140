"""Composed jobs and the query catalog with its DuckDB oracle."""
