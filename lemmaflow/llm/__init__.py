"""Operators for large-scale training data; nothing outside this package imports it."""
