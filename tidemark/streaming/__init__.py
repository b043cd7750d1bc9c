"""Streaming jobs: the same transforms on unbounded input."""
