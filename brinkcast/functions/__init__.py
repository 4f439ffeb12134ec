"""Column functions: built-in expressions only, no Python per row."""
