"""Operators of a training-data pipeline: extraction, deduplication, scoring, mixing, encoding."""
