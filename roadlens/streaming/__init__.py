"""Congestion alerts over a stream of reading files."""
