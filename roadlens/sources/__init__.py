"""Readers and writers. No reader infers a schema by scanning the data."""
