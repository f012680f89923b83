"""Operators of a training-data pipeline: dedup, scoring, encoding, packing, filtering, search."""
