"""Structured Streaming forms of the signal operators."""
