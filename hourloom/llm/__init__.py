"""Operators of a training-data pipeline: scans, rules, deduplication, language, sharding and packing of documents."""
