"""Whole stages and the queries over the bundled tables."""
