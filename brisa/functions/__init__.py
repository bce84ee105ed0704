"""Column functions: expressions only, no Python runs per row."""
