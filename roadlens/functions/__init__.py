"""Column expressions: rule bands, scalar parsing, calendar features."""
