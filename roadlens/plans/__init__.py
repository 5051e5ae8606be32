"""End-to-end jobs: read, derive, write."""
