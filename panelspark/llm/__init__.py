"""Operators for large text corpora and embeddings; nothing else in the library imports this package."""
