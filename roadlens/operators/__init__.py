"""Lazy DataFrame-to-DataFrame operators."""
