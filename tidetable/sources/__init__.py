"""Scans and sinks over files."""
