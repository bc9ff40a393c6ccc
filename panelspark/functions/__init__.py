"""Column expressions: codes, guarded arithmetic, casts."""
