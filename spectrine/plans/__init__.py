"""The pipeline language: parse, validate, plan, run."""
