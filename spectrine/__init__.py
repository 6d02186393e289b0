"""Spectral analytics and training-data operators on Spark."""
