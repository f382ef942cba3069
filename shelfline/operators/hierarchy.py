"""Parent-child hierarchies of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.joins import many_to_one
from shelfline.sources.scratch import stored


def ancestor_paths(nodes: DataFrame, key: str, parent: str, name: str) -> DataFrame:
    """(key, ancestors): all ancestors of each node, the nearest first, as (key, name).

    Paths double in each step: a node takes over the path of the last ancestor it knows, so a hierarchy of depth d takes
    log2(d) joins of one row per node. A parent that is no node ends the path. Nodes above which the parents go round in a
    circle raise an error, and so does a key that two nodes have."""
    links = nodes.select(F.col(key).alias("node"), F.col(parent).alias("last"))
    known = nodes.select(F.col(key).alias("known"), F.array(F.struct(F.col(key).alias("key"), F.col(name).alias("name"))).alias("path"))
    found = many_to_one(links, known, "last", "known")
    no_path = F.slice(F.array(F.struct(F.col("last").alias("key"), F.lit(None).cast("string").alias("name"))), 1, 0)
    paths = found.select("node", F.when(F.col("path").isNotNull(), F.col("last")).alias("last"), F.coalesce("path", no_path).alias("path"))
    while True:
        paths = stored(paths, "ancestor_paths")
        keys = F.transform("path", lambda p: p["key"])
        round_ = F.size(F.array_distinct(keys)) < F.size(keys)
        open_, circles = paths.agg(F.count("last"), F.count_if(round_ | F.array_contains(keys, F.col("node")))).first()
        if circles:
            raise ValueError(f"{circles} nodes of the hierarchy have parents that go round in a circle")
        if not open_:
            return paths.select(F.col("node").alias(key), F.col("path").alias("ancestors"))
        above = paths.select(F.col("node").alias("above"), F.col("last").alias("further"), F.col("path").alias("more"))
        joined = many_to_one(paths, above, "last", "above")
        longer = F.when(F.col("more").isNotNull(), F.concat("path", "more")).otherwise(F.col("path"))
        paths = joined.select("node", F.col("further").alias("last"), longer.alias("path"))


def with_ancestors(
    geography: DataFrame, levels: int | None = None, key: str = "geo_sk", parent: str = "parent_geo_sk", name: str = "geo_name"
) -> DataFrame:
    """The nodes with their ancestors: as columns parent_1_name, parent_2_name, ... up to ``levels``, or else as one array
    ``ancestor_names`` of any length. The nodes are computed once."""
    nodes = stored(geography, "hierarchy")
    paths = ancestor_paths(nodes, key, parent, name)
    walked = many_to_one(nodes, paths, key)
    names = F.transform("ancestors", lambda p: p["name"])
    if levels is None:
        return walked.withColumn("ancestor_names", names).drop("ancestors")
    columns = {f"parent_{n}_name": F.try_element_at(names, F.lit(n)) for n in range(1, levels + 1)}
    return walked.withColumns(columns).drop("ancestors")
