"""Predicates and derived categories used across the star."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import params


def since(day: Column, first: date, sk: Column | None = None) -> Column:
    """Dates from ``first`` on. With ``sk`` the bound is also put on the integer
    key, so that it reaches the scan and prunes partitions."""
    bound = day >= F.lit(first)
    return bound if sk is None else bound & (sk >= int(first.strftime("%Y%m%d")))


def at_period_end(day: Column) -> Column:
    return day == F.last_day(day)


def revenue_tier(
    amount: Column, tiers: Sequence[tuple[object, str]] = params.REVENUE_TIERS, lowest: str = params.LOWEST_TIER
) -> Column:
    """Name of the first tier whose threshold the amount exceeds; NULL is lowest."""
    named = F.lit(lowest)
    for threshold, label in reversed(list(tiers)):
        named = F.when(amount > F.lit(threshold), label).otherwise(named)
    return named


def admissible_channels(is_digital: Column, channel_type: Column) -> Column:
    """Channels a store may sell through, as an array of channel keys."""

    def keys(channels: Sequence[int]) -> Column:
        return F.array(*[F.lit(c) for c in channels])

    return (
        F.when(is_digital, keys(params.DIGITAL_CHANNELS))
        .when(channel_type == "WHOLESALE", keys(params.WHOLESALE_CHANNELS))
        .otherwise(keys(params.OWN_STORE_CHANNELS))
    )


def pick(options: Column, number: Column) -> Column:
    """A repeatable choice from an array, by a number such as a key or a hash."""
    return F.element_at(options, (F.pmod(number, F.size(options)) + 1).cast("int"))


def source_system(is_digital: Column) -> Column:
    return F.when(is_digital, "ECOM_PLATFORM").otherwise("POS_SYSTEM")


def sub_region(country: Column, region: Column, north_america: Sequence[str] = params.NORTH_AMERICA) -> Column:
    return F.when(country.isin(*north_america), "NORTH_AMERICA").otherwise(region)


def country_tier(country: Column, top: Sequence[str] = params.TOP_COUNTRIES) -> Column:
    return F.when(country.isin(*top), "TIER_1").otherwise("TIER_2")


def city_tier(country: Column, top: Sequence[str] = params.TOP_CITY_COUNTRIES) -> Column:
    return F.when(country.isin(*top), "TIER_2").otherwise("TIER_3")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current_flag"))


def guest_key(customer: Column) -> Column:
    """NULL customers become the guest key."""
    return F.coalesce(customer, F.lit(params.GUEST_CUSTOMER_SK).cast("bigint"))
