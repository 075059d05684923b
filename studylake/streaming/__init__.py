"""Incremental loads with Structured Streaming (S-3, S-4, S-5, R-1..R-3)."""
