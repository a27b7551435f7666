"""Column -> Column building blocks; all of them run inside generated code."""
