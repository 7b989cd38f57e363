"""Order events: ingest, deduplication, publication."""
