"""Readers and writers: table scans, derived feeds, payload parsing, sinks."""
