"""Column functions: scalars and predicates, all built from Spark expressions."""
