"""Incremental forms of the batch operators for Structured Streaming."""
