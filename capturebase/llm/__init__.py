"""Operators for preparing training data: filters, deduplication, scoring and mixing of documents."""
