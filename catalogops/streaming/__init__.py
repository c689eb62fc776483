"""Incremental ingest of record batches with Structured Streaming."""
