"""Operators on text corpora for training-data pipelines; nothing else in the library imports this package."""
