"""Structured Streaming variants of the line-level operators."""
