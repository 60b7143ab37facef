"""Operators for training-data pipelines: mixing, filtering, deduplication, tokens and packing."""
