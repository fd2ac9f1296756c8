"""Scalar Column functions (no Python UDFs)."""
