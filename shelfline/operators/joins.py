"""Joins of facts with dimensions, with each other and with themselves."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ordinals import ordinal_within
from shelfline.operators.sizing import broadcast_if_small, input_bytes, is_small
from shelfline.operators.validity import best_valid
from shelfline.sources.scratch import stored

# NULL keys find nothing, so they may lie in any of so many slots; the dimension has no row for these.
NULL_SLOTS = 1 << 20
# File bytes that one task of a join of two large tables gets.
TASK_BYTES = 8 * 1024 * 1024


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """The rows of a dimension, with an error if two of them have the same key. NULL keys, which nothing looks for, are left out."""
    others = [c for c in dim.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(1).alias("_any")])
    repeated = F.raise_error(F.concat(F.lit(f"repeated key {key}: "), F.col(key).cast("string")))
    rows = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.any_value(row).alias("_row"), F.count(F.lit(1)).alias("_rows"))
    checked = rows.select(key, F.when(F.col("_rows") == 1, F.col("_row")).otherwise(repeated).alias("_row"))
    return checked.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in others])


def many_to_one(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    how: str = "left",
    hot_keys: Sequence[object] = (),
    guarded: bool = True,
) -> DataFrame:
    """Look up one dimension row per fact row.

    A key that the dimension has twice raises an error, so facts are never multiplied; ``guarded=False`` leaves the check out
    where the dimension is made by a grouping on its key. A small dimension is broadcast. A large one is shuffled; then NULL
    keys and the keys named in ``hot_keys`` are spread over many partitions first, and adaptive execution splits any other
    heavy key.
    """
    dim_key = dim_key or fact_key
    small = is_small(dim)
    # Renamed so that the condition is unambiguous when both share a source.
    if guarded:  # what is broadcast fits one task, which then groups it without a shuffle
        dim = one_per_key(dim.coalesce(1) if small else dim, dim_key)
    dim = dim.withColumnRenamed(dim_key, "_dim_key")
    if small:
        joined = fact.join(F.broadcast(dim), F.col(fact_key) == F.col("_dim_key"), how)
        return joined.drop("_dim_key")
    return _spread_lookup(fact, dim, fact_key, how, list(hot_keys))


def _spread_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, how: str, hot_keys: list[object]) -> DataFrame:
    """Facts with hot keys are dealt over 16 slots for each partition of a shuffle, so that all partitions get about as many,
    and the few dimension rows of these keys are repeated for each slot."""
    spread = 16 * int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in fact.columns if c != fact_key] or [fact_key]
    key, row = F.col(fact_key), F.xxhash64(*others)
    # Zero for every key; written over the key so that it stays a join key.
    slots = F.array(F.pmod(F.xxhash64("_dim_key"), F.lit(1)).cast("int"))
    slot = F.when(key.isNull(), F.pmod(row, F.lit(NULL_SLOTS)))
    if hot_keys:
        all_slots = F.sequence(F.lit(0), F.lit(spread - 1))
        slots = F.when(F.col("_dim_key").isin(hot_keys), all_slots).otherwise(slots)
        slot = slot.when(key.isin(hot_keys), F.pmod(row, F.lit(spread)))
    left = fact.withColumn("_slot", slot.otherwise(F.lit(0)).cast("int"))
    # The optimizer knows file bytes only, of which a broadcast takes many times as much at the driver.
    right = dim.withColumn("_dim_slot", F.explode(slots)).hint("merge")
    matched = (key == F.col("_dim_key")) & (F.col("_slot") == F.col("_dim_slot"))
    return left.join(right, matched, how).drop("_slot", "_dim_slot", "_dim_key")


def large_inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join of two tables that both grow, on a key with few rows, such as an order's. Both are dealt by the key over a
    number of partitions that follows their bytes, so that what a task sorts, and what it aggregates after the join, has the
    same size however large and however compressible the tables are. A table of one task's size is left to the optimizer."""
    matched = F.col(left_key) == F.col(right_key)
    sizes = input_bytes(left), input_bytes(right)
    if None in sizes or min(sizes) <= TASK_BYTES:
        return left.join(right, matched, "inner")
    tasks = ceil(sum(sizes) / TASK_BYTES)
    return left.repartition(tasks, left_key).join(right.repartition(tasks, right_key), matched, "inner")


def star_inner(fact: DataFrame, *edges: tuple[DataFrame, str, str]) -> DataFrame:
    """Inner-join a fact with dimensions, each given as (frame, fact key, dim key)."""
    return reduce(lambda f, e: many_to_one(f, e[0], e[1], e[2], how="inner"), edges, fact)


def left_composite(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fill_zero: Iterable[str] = ()
) -> DataFrame:
    """Left join on several keys; the named right-hand columns become 0 where unmatched."""
    joined = left.join(right, list(keys), "left")
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in fill_zero}
    return joined.withColumns(zeros) if zeros else joined


def valid_promotion(
    sales: DataFrame, promotions: DataFrame, day: str = "transaction_date", keep: Sequence[str] = ()
) -> DataFrame:
    """Keep a sale's promotion only if the sale falls in one of its validities; never
    drop or repeat the sale. ``keep`` names promotion columns to add, NULL where none
    is valid; of several validities that cover the day the latest counts."""
    found = best_valid(sales, promotions, "promotion_sk", day, keep=keep)
    return found.withColumn("promotion_sk", F.when(F.col("_covered"), F.col("promotion_sk"))).drop("_covered")


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct non-NULL fact keys that the dimension does not hold."""
    keys = fact.select(F.col(fact_key).alias("orphan_key")).where(F.col("orphan_key").isNotNull()).distinct()
    known = dim.select(F.col(dim_key).alias("_known"))
    return keys.join(known, F.col("orphan_key") == F.col("_known"), "left_anti")


def only_known(fact: DataFrame, known: DataFrame, fact_key: str, known_key: str) -> DataFrame:
    """Facts whose key is among the known ones."""
    keys = known.select(F.col(known_key).alias("_known"))
    return fact.join(broadcast_if_small(keys), F.col(fact_key) == F.col("_known"), "left_semi")


def flag_matches(
    left: DataFrame, right: DataFrame, left_key: str | Sequence[str], right_key: str | Sequence[str], flag: str
) -> DataFrame:
    """Set ``flag`` to Y where the right side holds the key, else N. A key may have
    several columns: natural keys tell rows apart whose surrogate keys collide."""
    mine, theirs = ([k] if isinstance(k, str) else list(k) for k in (left_key, right_key))
    names = [f"_known_{i}" for i in range(len(theirs))]
    known = right.select(*[F.col(k).alias(n) for k, n in zip(theirs, names, strict=True)])
    known = known.where(reduce(Column.__and__, [F.col(n).isNotNull() for n in names])).distinct()
    same = reduce(Column.__and__, [F.col(k) == F.col(n) for k, n in zip(mine, names, strict=True)])
    joined = left.join(known, same, "left")
    return joined.withColumn(flag, F.when(F.col(names[0]).isNotNull(), "Y").otherwise("N")).drop(*names)


def on_spine(spine: DataFrame, daily: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per spine day (and key), with NULL values on days without data."""
    values = [c for c in daily.columns if c != day and c not in keys]
    filled = daily.select(F.col(day).alias("_d"), *[F.col(k).alias(f"_k_{k}") for k in keys], *values)
    same = [F.col(day) == F.col("_d")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return spine.join(filled, reduce(Column.__and__, same), "left").select(*spine.columns, *values)


def offset_by_days(daily: DataFrame, day: str, value: str, days: int, alias: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the value of the same keys ``days`` calendar days earlier."""
    earlier = daily.select(
        F.date_add(F.col(day), days).alias("_day"),
        F.col(value).alias(alias),
        *[F.col(k).alias(f"_{k}") for k in keys],
    )
    same = [F.col(day) == F.col("_day")] + [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return daily.join(earlier, reduce(Column.__and__, same), "left").drop("_day", *[f"_{k}" for k in keys])


def merge_results(results: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put separately computed results side by side, keeping keys found in any;
    a NULL key matches a NULL key. Each result has one row per key."""
    if not keys:
        return _merge_one_row(results)

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        renamed = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        joined = a.join(renamed, same, "full")
        key_cols = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys]
        values = [c for c in a.columns if c not in keys] + [c for c in b.columns if c not in keys]
        return joined.select(*key_cols, *values)

    return reduce(both, results)


def _merge_one_row(results: Sequence[DataFrame]) -> DataFrame:
    """Totals without keys: stack the one-row results and fold them into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def with_first_match(left: DataFrame, right: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Add the smallest ``value`` of each key on the right, NULL where there is none."""
    first = right.groupBy(F.col(key).alias("_key")).agg(F.min(value).alias(alias))
    return left.join(first, F.col(key) == F.col("_key"), "left").drop("_key")


def pair_in_order(
    left: DataFrame, right: DataFrame, group: str, left_key: str, right_key: str, takes_part: str
) -> DataFrame:
    """Give the n-th left row of a group, counting the rows whose ``takes_part`` is
    true, the key of the n-th right row of the same group; NULL for all others.

    Both sides are written as one table, numbered in one pass over slices of
    their keys, and meet by group and number: no group is put into one task, and
    neither side is computed twice. Rows that take no part are not shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    active = F.coalesce(F.col(takes_part), F.lit(False)) & F.col(group).isNotNull()
    ours = left.select(F.col(group).alias("_group"), F.col(left_key).alias("_key"), F.lit(True).alias("_left"), active.alias("_active"), row.alias("_row"))
    theirs = right.where(F.col(group).isNotNull()).select(
        F.col(group).alias("_group"), F.col(right_key).alias("_key"), F.lit(False).alias("_left"),
        F.lit(True).alias("_active"), F.lit(None).cast(ours.schema["_row"].dataType).alias("_row"),
    )
    both = stored(ours.unionByName(theirs), "pairs")
    numbered = ordinal_within(both.where("_active"), ["_group", "_left"], "_key", alias="_n")
    met = numbered.groupBy("_group", "_n").agg(
        F.any_value("_row", ignoreNulls=True).alias("_row"), F.max(F.when(~F.col("_left"), F.col("_key"))).alias(right_key)
    )
    idle = both.where("_left and not _active").select("_row", F.lit(None).cast(both.schema["_key"].dataType).alias(right_key))
    rows = met.where("_row is not null").select("_row", right_key).unionByName(idle)
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in left.columns], right_key)
