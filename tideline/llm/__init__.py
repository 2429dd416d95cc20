"""Operators of a training-data pipeline: dedup, packing, extraction, token files, search, quality, sharding."""
