"""Relational building blocks: joins, aggregates, windows, ordinals, samples."""
