"""Grouped aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.ratios import money_sum, unit_sum
from shelfline.operators.ordinals import ordinal_within


def finest_sums(df: DataFrame, keys: Sequence[str], money: Sequence[str], units: Sequence[str] = ()) -> DataFrame:
    """Sums at the finest grain a set of subtotals needs. Subtotals are then sums
    of these few rows, so the fact is neither expanded nor shuffled per level."""
    return df.groupBy(*keys).agg(
        *[money_sum(c).alias(c) for c in money], *[unit_sum(c).alias(c) for c in units]
    )


def rollup_totals(df: DataFrame, keys: Sequence[str], money: Sequence[str], units: Sequence[str] = ()) -> DataFrame:
    """Totals at every prefix of ``keys``, down to the grand total."""
    fine = finest_sums(df, keys, money, units)
    return fine.rollup(*keys).agg(
        *[money_sum(c).alias(c) for c in money], *[unit_sum(c).alias(c) for c in units]
    )


def grouping_set_totals(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    money: Sequence[str],
    units: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Totals for chosen key sets; ``flags`` maps a key to the name of its
    subtotal marker, 1 where the key is rolled up."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    fine = finest_sums(df, keys, money, units)
    markers = [F.grouping(k).cast("int").alias(name) for k, name in (flags or {}).items()]
    return fine.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        *markers, *[money_sum(c).alias(c) for c in money], *[unit_sum(c).alias(c) for c in units]
    )


def key_pages(df: DataFrame, group: str, key: str, page_size: int = 1000, alias: str = "keys") -> DataFrame:
    """The sorted keys of each group as arrays of at most ``page_size``; a group
    with more keys has several pages, so no array grows with the data."""
    numbered = ordinal_within(df.select(group, key), [group], key, alias="_n", slice_bits=20)
    page = F.floor((F.col("_n") - 1) / page_size).cast("bigint")
    return (
        numbered.withColumn("page", page)
        .groupBy(group, "page")
        .agg(F.sort_array(F.collect_list(key)).alias(alias))
    )


def first_per_group(df: DataFrame, group: str, key: str, alias: str) -> DataFrame:
    return df.groupBy(group).agg(F.min(key).alias(alias))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def latest_rows(df: DataFrame, day: str) -> DataFrame:
    """Rows of the last date. Where the frame is a table partitioned by the date,
    the maximum comes from its partition values and only that partition is read."""
    return df.where(F.col(day) == df.agg(F.max(day)).scalar())
