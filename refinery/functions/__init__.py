"""Column-expression helpers (scalar functions, variant access)."""
