"""Incremental ingestion as Structured Streaming."""
