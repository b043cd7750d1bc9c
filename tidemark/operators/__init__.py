"""Transforms of change rows: decode, flatten, reduce to state, join, rank."""
