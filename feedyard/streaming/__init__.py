"""Structured Streaming forms of the polling stages."""
