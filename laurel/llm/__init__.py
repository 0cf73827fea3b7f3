"""Operators for training-data pipelines: dedup, mixing, encoding, archives, filters, sharding."""
