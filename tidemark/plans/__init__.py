"""Operators applied to the standard tables, each with the same result in plain SQL."""
