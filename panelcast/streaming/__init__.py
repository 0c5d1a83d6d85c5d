"""Structured Streaming forms of ingest, deduplication, hourly totals and scoring."""
