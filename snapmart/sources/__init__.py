"""Readers and writers of the bronze, silver and gold layers."""
