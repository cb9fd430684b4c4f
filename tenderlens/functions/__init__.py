"""Column functions. All but the Jaro distance are built-in Spark expressions."""
