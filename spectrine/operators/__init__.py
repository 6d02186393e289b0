"""Relational operators over spectral datasets."""
