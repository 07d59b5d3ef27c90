"""Column expressions: text, arrays, scoring."""
