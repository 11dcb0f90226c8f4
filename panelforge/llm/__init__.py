"""Operators of a training-data pipeline: filtering, deduplication, tokenisation and layout of text corpora.

Nothing else in the library imports this package; ``catalog`` holds its registered queries.
"""
