"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; NULL when the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * 100


def round_half_up(value: Column, places: int) -> Column:
    """Decimal rounding of a double: the value is first taken to eight places, so
    that a quotient of exactly x.xx5 is not lost to binary representation."""
    return F.round(value.cast("decimal(38,8)"), places).cast("double")


def rounded_percent(numerator: Column, denominator: Column, places: int = 2) -> Column:
    return round_half_up(percent(numerator, denominator), places)


def growth_percent(current: Column, previous: Column) -> Column:
    return percent(current.cast("double") - previous.cast("double"), previous)


def money_sum(column: Column | str) -> Column:
    """Decimal sum of an amount, 20 digits before the point."""
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column).cast("decimal(24,4)")


def unit_sum(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column).cast("bigint")
