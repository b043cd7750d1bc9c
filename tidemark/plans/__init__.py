"""Business metrics, dashboard panels and checks over live or versioned rows.

Functions return unsorted frames; sorting is left to whoever shows them.
"""
