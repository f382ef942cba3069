"""Operator 9, exact dedup by skew-safe combining.

Equal texts are joined in three stages, each of which groups by the digest and by the full content, so that a collision
of digests never merges two texts:

1. within a task (map-side aggregation),
2. across tasks within a salt of the digest group, so that a group that holds a third of all rows is merged by many tasks,
3. the winners of the salts, at most one row per salt, text and digest.

Defined results: a null text counts as empty, and empty texts are equal; of equal texts the row with the largest id stays,
a null id is below all others; repeated rows (same id, same text) belong to one group and count in its size; an empty table
gives no rows; other columns are ignored by `exact_dedup` and carried whole by `distinct_documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = _sha256,
    salts: int = 16,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    salted = rows.groupBy("digest", "text", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    classes = (
        salted.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy("digest")))
    )
    # the text of a class is needed further only where another text has the same digest
    classes = stored(
        classes.select(
            "digest",
            "keep_id",
            "group_size",
            F.when(F.col("classes") > 1, F.col("text")).alias("other_text"),
        ),
        "classes",
    )
    alone = classes.where(F.col("other_text").isNull()).drop("other_text")
    shared = classes.where(F.col("other_text").isNotNull())
    out = rows.select("doc_id", "digest", _sha256(F.col("text")).alias("text_sha256")).join(alone, "digest")
    if not shared.isEmpty():  # texts under one digest: told apart by content
        told = rows.join(shared.withColumnRenamed("other_text", "text"), ["digest", "text"])
        out = out.unionByName(told.withColumn("text_sha256", _sha256(F.col("text"))).drop("text"))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def distinct_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = _sha256,
    salts: int = 16,
) -> DataFrame:
    """The rows that stay, one per text, with all their columns (a null text stays null). Repeated rows leave one."""
    others = [c for c in docs.columns if c != text_col]
    slot = {c: f"c{i}" for i, c in enumerate(others)}  # plain names, so that no column clashes with another
    rows = docs.select(
        F.struct(F.col(text_col).isNull().alias("null_text"), *[F.col(f"`{c}`").alias(n) for c, n in slot.items()]).alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("digest", digest(F.col("text")))
    id_ = F.col(f"row.{slot[id_col]}")
    rank = F.coalesce(id_.cast("long"), F.lit(-(2**63)))
    salted = rows.groupBy("digest", "text", F.pmod(F.xxhash64(id_), F.lit(salts)).alias("salt")).agg(
        F.max_by("row", rank).alias("row")
    )
    kept = salted.repartition("digest").groupBy("digest", "text").agg(F.max_by("row", rank).alias("row"))
    text = F.when(~F.col("row.null_text"), F.col("text"))
    return kept.select(*[(text if c == text_col else F.col(f"row.{slot[c]}")).alias(c) for c in docs.columns])
