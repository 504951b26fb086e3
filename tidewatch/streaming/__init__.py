"""Structured Streaming forms of the batch semantics."""
