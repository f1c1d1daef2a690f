"""Operators for large training-data pipelines (ten operators, one module each)."""
