"""Continuous versions of the pipelines."""
