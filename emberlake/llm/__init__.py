"""Operators of a training-data pipeline: packing, deduplication, filters, search and sharding."""
