"""Column expressions: text, time and money."""
