"""Column expressions, aggregate measures and distributed ordering helpers."""
