"""Compositions of operators over the given tables, each with its check in SQL."""
