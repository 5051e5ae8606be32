"""Operators for training-text pipelines."""
