"""Data-quality checks that run as Spark aggregates next to the data."""
