"""Operators for preparing training data: dedup, filters, mixing, sharding, search and token files."""
