"""Registered queries: each runs an operator over the given tables and has a SQL text to compare with."""
