"""Column -> Column expressions for the derived fields."""
