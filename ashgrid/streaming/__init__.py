"""Incremental ingest of yearly tables as they land (Structured Streaming)."""
