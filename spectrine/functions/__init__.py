"""Numeric kernels and column expressions."""
