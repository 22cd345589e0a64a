"""Operators of a training-data pipeline: text encoding, deduplication, filters, scoring."""
