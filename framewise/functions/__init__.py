"""Column expressions built from Spark SQL functions."""
