"""Incremental reads of the landing folder with Structured Streaming."""
