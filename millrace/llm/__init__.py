"""Operators for preparing training text: fingerprints, packing, deduplication, scoring, filtering, secrets."""
