"""Reusable DataFrame operators: ordering, versions, merges, quality checks."""
