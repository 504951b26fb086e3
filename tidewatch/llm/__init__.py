"""Operators for preparing training text: deduplication, quality, privacy, mixing, packing, search."""
