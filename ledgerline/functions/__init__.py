"""Column functions: text, parsing, keys and similarity."""
