"""Column expressions: geometry, text, rules. Nothing here starts Python on an executor."""
