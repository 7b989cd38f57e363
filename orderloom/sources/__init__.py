"""Readers: relational tables, parquet layers, catalog tables, event streams."""
