"""Column expressions: coercion of raw values and the risk model."""
