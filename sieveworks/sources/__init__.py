"""Readers and writers of documents, chunks and items."""
