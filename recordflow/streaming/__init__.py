"""Structured Streaming ingest of events."""
