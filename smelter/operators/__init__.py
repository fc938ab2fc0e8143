"""Relational operators: change folding, keys, lookups, merges, predicates, checks."""
