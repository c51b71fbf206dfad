"""Readers: parquet tables, Bronze / Silver layers, feeds, derived fixtures."""
