"""Readers: topics, source tables, test tables."""
