"""Structured Streaming entry points (incremental file-arrival readiness)."""
