"""Operators for large training-data pipelines; see the README."""
