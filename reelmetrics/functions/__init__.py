"""Column expressions: coercion, text, numbers, sentiment, brands."""
