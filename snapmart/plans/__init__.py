"""Whole pipelines and named reports, put together from the operators."""
