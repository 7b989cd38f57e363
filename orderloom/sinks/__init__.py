"""Writers: parquet layers, catalog tables, JSON events."""
