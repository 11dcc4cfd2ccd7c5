"""Column builders: text, rounding, geometry."""
