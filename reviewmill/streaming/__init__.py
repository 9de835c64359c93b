"""Structured Streaming jobs over the append-only review store."""
