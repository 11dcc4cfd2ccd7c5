"""Conflation of cycling data with road networks, and checks of it, as Spark DataFrame operators."""
