"""Operators of a training-data pipeline: cleaning, deduplication, mixing, formatting and storage of text."""
