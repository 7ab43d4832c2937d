"""Column helpers, all built-in expressions."""
