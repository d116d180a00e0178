"""Warehouse-building operators for Spark: typed ingest, history, as-of keys, upserts, quality rules."""
