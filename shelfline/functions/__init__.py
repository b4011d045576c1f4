"""Column expressions: week numbers, text parsing, JSON, exact quantiles."""
