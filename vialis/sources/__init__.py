"""Readers, table maintenance and writers."""
