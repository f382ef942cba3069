"""Stock levels from movements."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import date_to_sk, day_ordinal
from shelfline.functions.ratios import round_half_up
from shelfline.functions.text import stable_key
from shelfline.operators.windows import running_total


def available(on_hand: Column, reserved: Column) -> Column:
    return F.greatest(F.lit(0), on_hand - reserved)


def stock_value(on_hand: Column, unit: Column) -> Column:
    return (on_hand * unit).cast("decimal(16,4)")


def days_of_supply(on_hand: Column, daily_units: float = params.AVERAGE_DAILY_UNITS) -> Column:
    return round_half_up(on_hand.cast("double") / daily_units, 2)


def stock_turn(days: Column) -> Column:
    """Yearly turns; 0 without stock."""
    return F.when(days > 0, round_half_up(F.lit(365.0) / days, 4)).otherwise(F.lit(0.0))


def stockout(available_qty: Column) -> Column:
    return F.when(available_qty == 0, "Y").otherwise("N")


def _snapshot_days(every: str, first: Column, start: Column, stop: Column) -> Column:
    """Snapshot days from ``start`` to ``stop``, NULL if there are none: month ends,
    or every seventh day counted from ``first``."""
    if every == "month":
        months = F.sequence(F.trunc(start, "month"), F.trunc(stop, "month"), F.expr("interval 1 month"))
        return F.when(start <= stop, F.filter(F.transform(months, F.last_day), lambda d: d <= stop))
    due = F.date_add(start, F.pmod(F.datediff(first, start), F.lit(7)))
    return F.when(due <= stop, F.sequence(due, stop, F.expr("interval 7 days")))


def snapshot_grid(movements: DataFrame, keys: Sequence[str], day: str, last_day: date | Column, every: str) -> DataFrame:
    """Snapshot days of each stocked pair, from its first movement on. Only pairs
    that moved get rows."""
    starts = movements.groupBy(*keys).agg(F.min(day).alias("_first"))
    days = _snapshot_days(every, F.col("_first"), F.col("_first"), F.lit(last_day))
    return starts.select(*keys, F.explode(days).alias(day))


def stock_levels(
    movements: DataFrame, keys: Sequence[str], day: str, opening: int, last_day: date | Column, every: str = "month"
) -> DataFrame:
    """Stock at each snapshot day, carried forward from the movements before it.

    ``movements`` holds units_received and units_sold per key and day. Each day's
    level holds until the day before the next movement, so it fills the snapshot
    days of that stretch: one pass over the movements, no spine and no as-of join."""
    daily = movements.groupBy(*keys, day).agg(
        F.sum("units_received").alias("_in"), F.sum("units_sold").alias("_out")
    ).withColumn("_net", F.col("_in") - F.col("_out"))
    of_pair = Window.partitionBy(*keys)
    following = F.lead(day).over(of_pair.orderBy(day_ordinal(F.col(day))))
    levels = daily.select(
        *keys,
        F.col(day).alias("_day"),
        "_in",
        "_out",
        (F.lit(opening) + running_total("_net", keys, day)).cast("bigint").alias("on_hand_qty"),
        F.min(day).over(of_pair).alias("_first"),
        F.least(F.date_sub(following, 1), F.lit(last_day)).alias("_until"),
    )
    days = _snapshot_days(every, F.col("_first"), F.col("_day"), F.col("_until"))
    filled = levels.select(*keys, F.explode(days).alias(day), "on_hand_qty", "_in", "_out", "_day")
    moved_today = F.col(day) == F.col("_day")
    return filled.select(
        *keys,
        day,
        F.when(moved_today, F.col("_in")).otherwise(0).alias("units_received_today"),
        F.when(moved_today, F.col("_out")).otherwise(0).alias("units_sold_today"),
        "on_hand_qty",
    )


def build_inventory_snapshot(levels: DataFrame, day: str) -> DataFrame:
    """From stock levels with unit_cost and unit_retail to snapshot rows."""
    on_hand = F.col("on_hand_qty")
    number = F.col("product_sk") + F.col("store_sk") + F.month(F.col(day))
    with_stock = levels.withColumns(
        {
            "in_transit_qty": F.when(on_hand < 50, F.pmod(number, F.lit(30))).otherwise(0).cast("bigint"),
            "on_order_qty": F.when(on_hand < 30, F.pmod(number, F.lit(50))).otherwise(0).cast("bigint"),
            "reserved_qty": F.greatest(F.lit(0), F.least(F.pmod(number, F.lit(10)), on_hand)).cast("bigint"),
        }
    ).withColumn("available_to_sell_qty", available(on_hand, F.col("reserved_qty")).cast("bigint"))
    return with_stock.select(
        stable_key(F.col("product_sk"), F.col("store_sk"), date_to_sk(F.col(day))).alias("inventory_sk"),
        F.col(day).alias("snapshot_date"),
        date_to_sk(F.col(day)).alias("snapshot_date_sk"),
        "product_sk",
        "store_sk",
        "on_hand_qty",
        "in_transit_qty",
        "on_order_qty",
        "reserved_qty",
        "available_to_sell_qty",
        "units_received_today",
        "units_sold_today",
        stock_value(on_hand, F.col("unit_cost")).alias("inventory_cost_value"),
        stock_value(on_hand, F.col("unit_retail")).alias("inventory_retail_value"),
        F.lit(params.REORDER_POINT).alias("reorder_point"),
        days_of_supply(on_hand).alias("days_of_supply"),
        stock_turn(days_of_supply(on_hand)).alias("stock_turn_rate"),
        stockout(F.col("available_to_sell_qty")).alias("stockout_flag"),
    )
