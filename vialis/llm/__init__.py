"""Operators for large text collections that are prepared as training data."""
