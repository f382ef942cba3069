"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    """(a, least of a and its neighbours), combined on the map side and stored, so that a hot node's join can be split."""
    return stored(edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")


def connected_components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of longs: (node, component), the component being its least node, for every node with an edge.

    Each step joins edges with one row per node; a node with very many edges is split by the adaptive skew join. The
    number of steps grows with the logarithm of a component's diameter. Edges with a null at an end, or from a node to itself,
    are left out; repeated edges count once; without edges there are no rows.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(large.where("a != b").distinct(), "edges")
        least = _least(edges)
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b")
        edges = stored(small.distinct(), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
