"""Incremental ingest of interval files."""
