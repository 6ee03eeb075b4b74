"""Column expressions, all evaluated by Spark's native functions."""
