"""Structured Streaming sources, window alerts and the insert-once sink."""
