"""Queries over the given tables and the SQL that must return the same rows."""
