"""Incremental (Structured Streaming) variants of the counting and index jobs."""
