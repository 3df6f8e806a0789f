"""Incremental staging of newly landed raw files (Structured Streaming)."""
