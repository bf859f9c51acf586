"""Operators of a training-data pipeline: deduplication, scoring, tokens, packing, pseudonyms."""
