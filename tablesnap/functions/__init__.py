"""Column expressions: typed coercion, table identity and report texts."""
