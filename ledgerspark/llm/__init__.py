"""Operators of a training-data pipeline: filters, dedup, scans, tokens and mixing over documents."""
