"""Operators for training-data pipelines: tokens, duplicates, shards, languages, scores, personal data, leaks."""
