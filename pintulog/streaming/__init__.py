"""Structured Streaming variants of the landing and hit-count jobs."""
