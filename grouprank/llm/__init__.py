"""Operators for preparing training data: packing, search, counting, deduplication, scoring, filtering."""
