"""Structured Streaming forms of scoring and searching."""
