"""Column expressions and aggregation helpers shared by the operators."""
