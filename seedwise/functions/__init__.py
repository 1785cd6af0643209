"""Column expressions and vector helpers (built-in Spark functions only)."""
