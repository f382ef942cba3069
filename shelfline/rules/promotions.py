"""Promotion dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import date_to_sk
from shelfline.functions.text import title_from_code, zero_padded_key
from shelfline.operators.filters import pick

# Words of the promotion dimension.
PROMOTION_TYPES = ("MARKDOWN", "COUPON", "BOGO", "BUNDLE", "LOYALTY", "CLEARANCE")
DISCOUNT_TYPES = ("PERCENT", "FIXED_AMOUNT", "FREE_GIFT")
CAMPAIGN_CATEGORIES = ("SEASONAL", "SPORT", "PRODUCT_LAUNCH", "CLEARANCE", "MEMBER_EXCLUSIVE")
MARKETING_CHANNELS = ("EMAIL", "APP", "IN_STORE", "SOCIAL", "WEB", "SMS")
PERCENT_STEPS = (10, 15, 20, 25, 30, 40, 50)
AMOUNT_STEPS = (5, 10, 15, 20, 25, 50)


def words(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def clamped_end(start: Column, days: Column, horizon: date | Column) -> Column:
    """Last day of a promotion, never after the horizon."""
    return F.least(F.date_add(start, days), F.lit(horizon))


def status(end: Column, horizon: date | Column) -> Column:
    return F.when(end >= F.lit(horizon), "ACTIVE").otherwise("COMPLETED")


def build_dim_promotion(raw: DataFrame, horizon: date | Column) -> DataFrame:
    """From (promotion_sk, start_date, duration_days, category_name) to promotions."""
    sk = F.col("promotion_sk")
    kind = pick(words(DISCOUNT_TYPES), sk)
    value = (
        F.when(kind == "PERCENT", pick(words(PERCENT_STEPS), sk))
        .when(kind == "FIXED_AMOUNT", pick(words(AMOUNT_STEPS), sk))
        .otherwise(0)
    )
    campaign = pick(words(CAMPAIGN_CATEGORIES), sk)
    promo_type = pick(words(PROMOTION_TYPES), sk)
    end = clamped_end(F.col("start_date"), F.col("duration_days"), horizon)
    return raw.select(
        sk,
        zero_padded_key("PROMO-", sk, 5).alias("promotion_nk"),
        F.concat_ws(" ", title_from_code(campaign), title_from_code(promo_type), sk.cast("string")).alias("promotion_name"),
        promo_type.alias("promotion_type"),
        kind.alias("discount_type"),
        value.cast("decimal(8,4)").alias("discount_value"),
        F.concat_ws(" ", campaign, F.lit("Campaign"), (F.floor(sk / 10) + 1).cast("string")).alias("campaign_name"),
        campaign.alias("campaign_category"),
        pick(words(MARKETING_CHANNELS), sk).alias("marketing_channel"),
        F.col("start_date"),
        end.alias("end_date"),
        date_to_sk(F.col("start_date")).alias("start_date_sk"),
        date_to_sk(end).alias("end_date_sk"),
        F.col("category_name").alias("applicable_product_category"),
        (F.pmod(sk, F.lit(5)) == 0).alias("stackable_flag"),
        status(end, horizon).alias("promotion_status"),
    )
