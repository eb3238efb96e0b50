"""Operators of a training-data pipeline over the documents table."""
