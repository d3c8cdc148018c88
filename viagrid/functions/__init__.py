"""Column expressions, all built into Spark."""
