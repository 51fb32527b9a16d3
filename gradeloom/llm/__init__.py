"""Operators of a training-data pipeline: sharding, deduplication, filtering, redaction, packing."""
