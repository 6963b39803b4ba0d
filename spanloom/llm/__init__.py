"""Operators for large text corpora used as language-model training data."""
