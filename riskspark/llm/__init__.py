"""Operators for building training corpora (deduplication, filtering, scoring, encoding)."""
