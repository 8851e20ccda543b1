"""Incremental ingest of raw files by Structured Streaming."""
