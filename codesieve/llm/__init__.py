"""Operators of a training-data pipeline: quality, duplicates, contamination, archives, counts, URLs, shards, mixtures, secrets."""
