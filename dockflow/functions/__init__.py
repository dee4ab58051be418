"""Column expressions. Each function takes columns and returns a column."""
