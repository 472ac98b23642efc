"""Operators for training-data pipelines: sharding, filters, search, deduplication, packing and mixing."""
