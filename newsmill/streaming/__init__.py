"""Structured Streaming forms of ingest, seen-state and alarms."""
