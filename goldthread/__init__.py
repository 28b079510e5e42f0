"""Metadata-driven record reconciliation as Spark DataFrame transformations."""
