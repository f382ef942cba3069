"""Repeatable samples: the same rows whenever a task runs again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_percent(df: DataFrame, key: Column, percent: int) -> DataFrame:
    """About ``percent`` of the rows, chosen by a well-spread integer key."""
    return df.where(F.pmod(key, F.lit(100)) < percent)


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in the order of the key's hash; a top-n, not a full sort."""
    return df.orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(n)


def every_nth_day(day: Column, start: Column, n: int) -> Column:
    return F.pmod(F.datediff(day, start), F.lit(n)) == 0
