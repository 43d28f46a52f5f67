"""Operators for preparing training data: search, scoring, mixing, deduplication, archives, sharding."""
