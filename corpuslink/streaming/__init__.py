"""Structured Streaming ingest (O-91)."""
