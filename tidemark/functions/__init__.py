"""Column expressions; all are built-in Spark functions, so they stay in code generation."""
