"""Structured Streaming jobs (the message path of the ingest)."""
