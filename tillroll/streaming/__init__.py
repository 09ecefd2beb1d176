"""Incremental Silver maintenance with Structured Streaming."""
