"""Column expressions: variants, text, normal tails, derived statistics."""
