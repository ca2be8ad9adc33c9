"""Operators of a training-data pipeline: dedup, filters, scans, mixing and sharding of a text corpus."""
