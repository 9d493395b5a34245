"""Incremental scans, dated files, typed loads and rerun-safe sinks."""
