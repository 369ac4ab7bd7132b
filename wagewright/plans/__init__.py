"""Queries over the given tables, registered next to their SQL."""
