"""Operators over text, vectors and corpora for training-data pipelines."""
