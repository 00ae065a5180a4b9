"""Column expressions: calendar rules, error measures, decisions."""
