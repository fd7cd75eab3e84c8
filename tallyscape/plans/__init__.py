"""Operators put together: the batch stages, and the queries over the given tables."""
