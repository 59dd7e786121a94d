"""Operators for training-data pipelines: dedup, quality, language, secrets, tokens, packing, media."""
