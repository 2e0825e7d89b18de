"""Operators for preparing training data: sampling, search, scoring, deduplication and packing."""
