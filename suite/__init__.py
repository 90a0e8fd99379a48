"""Queries over the given tables, shaped like the landed sources."""
