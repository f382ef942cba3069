"""Retail star-schema analytics as Spark DataFrame transformations."""
