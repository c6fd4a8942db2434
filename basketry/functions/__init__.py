"""Column expressions and the distributed ordering primitives."""
