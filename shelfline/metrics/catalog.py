"""The declared metrics and dimensions as data."""

from __future__ import annotations

from dataclasses import astuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.metrics.model import Derived, Layer, Simple, Windowed

CATALOG_SCHEMA = """
    layer STRING, name STRING, kind STRING, label STRING, comment STRING, synonyms ARRAY<STRING>,
    declared_format STRING,
    format STRUCT<type: STRING, currency_code: STRING, places: INT, compact: BOOLEAN, fraction: BOOLEAN, grouped: BOOLEAN,
      date_order: STRING, leading_zeros: BOOLEAN>
"""


def _kind(entry: object) -> str:
    kinds = {Simple: "simple", Derived: "derived", Windowed: "cumulative"}
    return kinds.get(type(entry), "dimension")


def metric_catalog(spark: SparkSession, layer: Layer) -> DataFrame:
    """One row per metric and dimension of the layer."""
    rows = []
    for entry in (*layer.metrics.values(), *layer.dimensions.values()):
        f = entry.format
        shown = astuple(f) if f else None
        rows.append((layer.name, entry.name, _kind(entry), entry.label, entry.comment, list(entry.synonyms), f.declared if f else None, shown))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_terms(catalog: DataFrame) -> DataFrame:
    """Every word a metric or dimension answers to: its name, label and synonyms."""
    words = F.array_union(F.array("name", "label"), "synonyms")
    lowered = F.array_distinct(F.transform(words, F.lower))
    return catalog.select(F.explode(lowered).alias("term"), "name", "kind")


def lookup_terms(terms: DataFrame, catalog: DataFrame) -> DataFrame:
    """Resolve the column ``term`` of any frame; unknown terms keep a NULL name."""
    wanted = terms.withColumn("_term", F.lower(F.trim("term")))
    known = catalog_terms(catalog).withColumnRenamed("term", "_known")
    return wanted.join(F.broadcast(known), F.col("_term") == F.col("_known"), "left").drop("_term", "_known")
