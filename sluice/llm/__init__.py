"""Operators of a training-data pipeline (toxicity, search, mixing, decontamination, token
files, sharding, joins, personal data, deduplication).  Nothing else in the library imports it."""
