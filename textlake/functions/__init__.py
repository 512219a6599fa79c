"""Column -> Column functions on text and token arrays."""
