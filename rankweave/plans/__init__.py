"""Operators put together: the three jobs and the queries over the given tables."""
