"""Compositions of operators: the monthly job, and queries over the given tables."""
