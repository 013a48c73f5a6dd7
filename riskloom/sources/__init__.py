"""Scans, derived fixture views and sinks."""
