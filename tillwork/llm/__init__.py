"""Operators over text corpora for training-data pipelines; nothing else in the library imports them."""
