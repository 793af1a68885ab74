"""Operators of a training-data pipeline over text corpora, and their queries."""
