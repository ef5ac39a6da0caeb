"""Operators on text corpora and vectors for training data."""
