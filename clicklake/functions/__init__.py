"""Column expressions and small reusable plans."""
