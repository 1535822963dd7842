"""Operators of a training-data pipeline: tokenizers, similarity joins, mixing, deduplication, extraction, archives."""
