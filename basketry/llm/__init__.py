"""Operators for training-data pipelines: sharding, tokenizing, packing, filtering, deduplication, search."""
