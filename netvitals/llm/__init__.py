"""Operators for building training data: one module per operator, ``queries`` registers them."""
