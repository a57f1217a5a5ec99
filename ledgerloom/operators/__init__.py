"""Reusable DataFrame operators (joins, ranking, top-1, staging rules, quality rules)."""
