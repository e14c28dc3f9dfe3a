"""Operators for text that becomes training data, and the queries that apply them to the given tables."""
