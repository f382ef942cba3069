"""Operators for building language-model training corpora, as Spark jobs."""
