"""Operators over documents, chunks, question-answer items and vectors."""
