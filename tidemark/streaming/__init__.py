"""Structured Streaming forms of the bucketed counts."""
