"""Column expressions and small distributed helpers."""
