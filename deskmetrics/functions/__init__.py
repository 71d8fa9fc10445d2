"""Column expressions of the business rules."""
