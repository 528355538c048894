"""Column expressions; all of them stay inside Spark's code generation."""
