"""Structured Streaming forms of ingest and the Bronze -> Silver step."""
