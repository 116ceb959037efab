"""Snapshot analytics on Spark: bronze JSON batches to a star schema and reports."""
