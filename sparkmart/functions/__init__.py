"""Column functions; all of them compose built-in Spark expressions."""
