"""Sinks: per-message CSV outputs, formatted rows, raw frame bytes and capture files."""
