"""Scans, derived input tables and sinks."""
