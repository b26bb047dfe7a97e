"""Column expressions (Column -> Column) and the fixed payload schemas."""
