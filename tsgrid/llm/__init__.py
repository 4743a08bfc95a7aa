"""Operators for large training-text pipelines (documents, pages, embeddings)."""
