"""Structured Streaming ingest into bronze."""
