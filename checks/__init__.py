"""Registered queries, their inputs over the given tables, and the SQL they must equal."""
