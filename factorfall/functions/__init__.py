"""Column expressions and grouping helpers."""
