"""Queries over the given tables, with an SQL oracle for each."""
