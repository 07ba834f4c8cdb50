"""Scans and sinks: quarterly raw folders, tab-separated text, layered tables, staged intermediates."""
