"""Incremental maintenance of tables by Structured Streaming."""
