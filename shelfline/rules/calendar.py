"""The calendar: day spine, date dimension, seasonality."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import calendar_columns


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, column ``date_day``."""
    return spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_day")
    )


def days_of(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last date of a column."""
    ends = df.agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return ends.select(F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias("date_day"))


def build_dim_date(days: DataFrame, *columns: str) -> DataFrame:
    """The date dimension, or some of its columns, for the days of ``date_day``."""
    attributes = calendar_columns(F.col("date_day"), columns)
    return days.select(*[c.alias(n) for n, c in attributes.items()])


def day_weight() -> Column:
    """Unnormalised sales weight of a date-dimension row; a decimal, so that sums are exact."""
    product = (
        F.when(F.col("quarter_num") == 4, params.FOURTH_QUARTER_UPLIFT).otherwise(1.0)
        * F.when(F.col("is_black_friday") | F.col("is_cyber_monday"), params.SALE_DAY_UPLIFT).otherwise(1.0)
        * F.when(F.col("is_weekend"), params.WEEKEND_UPLIFT).otherwise(1.0)
        * F.when(F.col("is_back_to_school"), params.BACK_TO_SCHOOL_UPLIFT).otherwise(1.0)
    )
    return product.cast("decimal(12,4)")


def seasonality(dim_date: DataFrame) -> DataFrame:
    """Share of each day in all sales; shares add up to 1. One row per calendar day."""
    weighted = dim_date.withColumn("raw_weight", day_weight())
    total = F.sum("raw_weight").over(Window.partitionBy())
    return weighted.withColumn("weight", F.col("raw_weight").cast("double") / total.cast("double"))
