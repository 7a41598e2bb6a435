"""Column functions: pure projections over built-in Spark expressions."""
