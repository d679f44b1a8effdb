"""Operators for preparing training data: filtering, deduplication, privacy, mixing, packing."""
