"""Column expressions: missing values, event time, engagement signals, rounding."""
