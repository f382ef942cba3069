"""Exact distinct counts that can be merged.

A set of whole numbers is a table of bitmaps: one row per group and bucket of 32,768 numbers. Sets of days merge into sets of
months, and sets of fine groups into those of any coarser ones, by a bitwise or; the facts are read once, when the sets are
made. Values that are no dense whole numbers get their numbers from a dictionary. A bitmap takes 4 KB in memory; on disk and in
a shuffle, compression leaves little more than its set bits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 4096


def dictionary(df: DataFrame, column: str, number: str = "number", slots: int = SLOTS) -> DataFrame:
    """Each different value of a column with a number of its own, from 1 without gaps.

    Values are numbered within slots of their hash, and each slot adds the count of those before it, so no task sees all
    values; the slots' counts are one small table. The same values get the same numbers."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_slot", F.pmod(F.xxhash64(column), F.lit(slots)))
    before = Window.partitionBy().orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = values.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_slot").orderBy(column))
    return values.withColumn("_inside", inside).join(starts, "_slot").select(column, (F.col("_start") + F.col("_inside")).alias(number))


def sets_of(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """The set of numbers of each group: keys, bucket, bits. NULL numbers are in no set."""
    held = df.where(F.col(number).isNotNull())
    rows = held.select(*keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_bit"))
    # dealt by group and bucket before the bitmaps are made: a shuffled number is smaller than a bitmap that holds it
    return rows.repartition(*keys, "bucket").groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged(sets: DataFrame, keys: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """The union of the sets that fall into each coarser group; keys may be expressions, such as the month of a day."""
    columns = [c.alias(k) for k, c in keys.items()] if isinstance(keys, Mapping) else [F.col(k) for k in keys]
    return sets.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """The number of members of each group's set."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(alias))


def set_sizes(sets: DataFrame, keys: Mapping[str, Column] | Sequence[str], alias: str) -> DataFrame:
    """Distinct counts of coarser groups."""
    return sizes(merged(sets, keys), list(keys), alias)


def grouping_set_sizes(
    sets: DataFrame, chosen: Sequence[Sequence[str]], alias: str, flags: Mapping[str, str] | None = None
) -> DataFrame:
    """Distinct counts for chosen key sets; ``flags`` maps a key to the name of its subtotal marker, 1 where the key is rolled
    up. Bitmaps are repeated for each key set, facts are not."""
    keys = list(dict.fromkeys(k for s in chosen for k in s))
    marks = [F.grouping(k).cast("int").alias(f"_up_{k}") for k in keys]
    columns = [[F.col(c) for c in (*s, "bucket")] for s in chosen]
    united = sets.groupingSets(columns, *[F.col(c) for c in (*keys, "bucket")]).agg(F.bitmap_or_agg("bits").alias("bits"), *marks)
    counted = sizes(united, [*keys, *[f"_up_{k}" for k in keys]], alias)
    shown = [F.col(f"_up_{k}").alias(name) for k, name in (flags or {}).items()]
    return counted.select(*shown, *keys, alias)


def with_numbers(df: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    """Rows with their value's number from a dictionary; NULL stays NULL."""
    known = numbers.withColumnRenamed(column, "_value")
    return df.join(known, F.col(column) == F.col("_value"), "left").drop("_value")


def union_of(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Sets of several tables, such as a stored one and that of the last day, as one."""
    return merged(reduce(DataFrame.unionByName, [p.select(*keys, "bucket", "bits") for p in parts]), keys)
