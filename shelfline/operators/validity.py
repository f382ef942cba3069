"""Facts and the validities that cover their day: an interval join by buckets of days.

A validity is put under each bucket of days that it touches, so a fact looks up one row by key and bucket, with all validities
that may cover its day, and tests their exact bounds in place. Facts are not multiplied by validities that miss them. Validities
that touch very many buckets, such as open-ended ones, are looked up by key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import day_ordinal
from shelfline.operators.sizing import is_small

BUCKET_DAYS = 32
MOST_BUCKETS = 64
SPREAD = 16
_ALL_BUCKETS = -(2**31)


def _bucket(day: Column) -> Column:
    return F.floor(day_ordinal(day) / BUCKET_DAYS).cast("int")


def validity_index(validities: DataFrame, key: str, first: str, last: str, keep: Sequence[str]) -> DataFrame:
    """(_key, _bucket, _offers): validities by key and bucket of days, each with its bounds and the columns to keep."""
    offer = F.struct(F.col(first).alias("first"), F.col(last).alias("last"), *[F.col(c) for c in keep])
    begin, end = _bucket(F.col(first)), _bucket(F.col(last))
    buckets = F.when(end - begin >= MOST_BUCKETS, F.array(F.lit(_ALL_BUCKETS))).otherwise(F.sequence(begin, end))
    usable = validities.where(F.col(key).isNotNull() & (F.col(first) <= F.col(last)))
    placed = usable.select(F.col(key).alias("_key"), F.explode(buckets).alias("_bucket"), offer.alias("_offer"))
    return placed.groupBy("_key", "_bucket").agg(F.collect_list("_offer").alias("_offers"))


def _with_offers(facts: DataFrame, validities: DataFrame, key: str, day: str, first: str, last: str, keep: Sequence[str]) -> DataFrame:
    """Facts with `_valid`, the validities of their key that cover their day, as an array that may be empty."""
    index = validity_index(validities, key, first, last, keep)
    if is_small(validities):
        by_key, found = F.broadcast, facts.withColumns({"_slot": F.lit(0), "_at": _bucket(F.col(day))})
        spread = index.withColumn("_to", F.lit(0))
    else:  # a key may have a large part of the facts: they are dealt out by bucket and slot too
        by_key, found = (lambda df: df), facts.withColumns({"_slot": F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int"), "_at": _bucket(F.col(day))})
        spread = index.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    nothing = None
    for name, at in (("_near", F.col("_at")), ("_always", F.lit(_ALL_BUCKETS))):
        chosen = spread.where((F.col("_bucket") == _ALL_BUCKETS) == (name == "_always")).select("_key", "_bucket", "_to", F.col("_offers").alias(name))
        same = (F.col(key) == F.col("_key")) & (at == F.col("_bucket")) & (F.col("_slot") == F.col("_to"))
        found = found.join(by_key(chosen), same, "left").drop("_key", "_bucket", "_to")
        nothing = F.array().cast(chosen.schema[name].dataType)
    offers = F.concat(F.coalesce("_near", nothing), F.coalesce("_always", nothing))
    covers = F.filter(offers, lambda o: F.col(day).between(o["first"], o["last"]))
    return found.withColumn("_valid", covers).drop("_near", "_always", "_slot", "_at")


def every_valid(
    facts: DataFrame, validities: DataFrame, key: str, day: str, first: str = "start_date", last: str = "end_date", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per fact and validity of its key that covers its day, with the columns to keep; both bounds are included."""
    found = _with_offers(facts, validities, key, day, first, last, keep)
    rows = found.select(*[F.col(f"`{c}`") for c in facts.columns], F.explode("_valid").alias("_offer"))
    return rows.select(*[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"_offer.`{c}`") for c in keep])


def best_valid(
    facts: DataFrame, validities: DataFrame, key: str, day: str, first: str = "start_date", last: str = "end_date", keep: Sequence[str] = ()
) -> DataFrame:
    """Every fact once, with `_covered` and the kept columns of the validity that covers its day, NULL if none does. Of several
    the one that began last, then the one that ends first, then the one with the least kept columns."""
    found = _with_offers(facts, validities, key, day, first, last, keep)
    ranked = F.transform("_valid", lambda o: F.struct((-day_ordinal(o["first"])).alias("late"), day_ordinal(o["last"]).alias("end"), *[o[c].alias(f"c{i}") for i, c in enumerate(keep)]))
    best = found.withColumn("_best", F.array_min(ranked)).drop("_valid")
    kept = {c: F.col(f"_best.c{i}") for i, c in enumerate(keep)}
    return best.withColumns({"_covered": F.col("_best").isNotNull(), **kept}).drop("_best")
