"""Structured Streaming: deduplication, windows, lateness and idempotent sinks."""
