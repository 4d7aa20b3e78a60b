"""Continuous loads from change files."""
