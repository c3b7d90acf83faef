"""Column expressions and the few Arrow-batched text functions."""
