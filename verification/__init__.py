"""Registered queries over the given test tables, and the same results in plain SQL."""
