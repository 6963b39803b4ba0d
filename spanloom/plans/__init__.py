"""Composite pipelines and the query registry."""
