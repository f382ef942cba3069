"""Return lines made from sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions.dates import date_to_sk
from shelfline.functions.text import code_lookup, stable_key
from shelfline.operators.filters import pick
from shelfline.rules.promotions import words


def return_condition(reason: Column, number: Column) -> Column:
    """Defective and damaged goods are rarely saleable, other returns mostly are."""
    draw = F.pmod(number, F.lit(20))
    faulty = reason.isin("DEFECT", "DAMAGED")
    saleable, damaged, defective = params.RETURN_CONDITIONS
    return (
        F.when(faulty & (draw < 2), saleable)
        .when(faulty & (draw < 10), damaged)
        .when(faulty, defective)
        .when(draw < 17, saleable)
        .when(draw < 19, damaged)
        .otherwise(defective)
    )


def restocking_fee(amount: Column, condition: Column, reason: Column) -> Column:
    due = (condition != "SALEABLE") | (reason == "CHANGED_MIND")
    fee = (amount * F.lit(params.RESTOCKING_FEE_RATE).cast("decimal(3,2)")).cast("decimal(14,4)")
    return F.when(due, fee).otherwise(F.lit(0).cast("decimal(14,4)"))


def within_window(days: Column, limit: int = params.RETURN_WINDOW_DAYS) -> Column:
    return days <= limit


def build_fact_returns(sales: DataFrame, horizon: date | Column) -> DataFrame:
    """One return line per sale given; returns after the horizon are dropped.

    Needs the sale's keys and prices, ``order_number``, ``return_delay`` and
    ``quantity_returned``. A natural key of the sale, ``transaction_nk``, goes
    along as ``original_transaction_nk``."""
    reason = pick(words(params.RETURN_REASONS), F.col("product_sk"))
    coded = sales.withColumns(
        {
            "return_date": F.date_add(F.col("transaction_date"), F.col("return_delay")),
            "return_reason_code": reason,
            "return_condition": return_condition(reason, F.col("order_number")),
            "return_retail_amount": (F.col("quantity_returned") * F.col("unit_retail_price")).cast("decimal(14,4)"),
            "return_cost_amount": (F.col("quantity_returned") * F.col("unit_cost_price")).cast("decimal(14,4)"),
        }
    ).where(F.col("return_date") <= F.lit(horizon))
    fee = restocking_fee(F.col("return_retail_amount"), F.col("return_condition"), F.col("return_reason_code"))
    return coded.select(
        stable_key(F.lit("RET"), F.col("transaction_sk")).alias("return_sk"),
        F.concat(
            F.lit("RET-"), F.upper(F.substring(F.md5(F.col("transaction_sk").cast("string")), 1, 8))
        ).alias("return_id"),
        F.lit(1).alias("return_line_number"),
        "return_date",
        date_to_sk(F.col("return_date")).alias("return_date_sk"),
        F.col("transaction_sk").alias("original_transaction_sk"),
        F.col("transaction_date_sk").alias("original_transaction_date_sk"),
        "customer_sk",
        "product_sk",
        "store_sk",
        "channel_sk",
        "return_reason_code",
        code_lookup(F.col("return_reason_code"), params.RETURN_REASONS).alias("return_reason_desc"),
        "return_condition",
        "quantity_returned",
        "return_retail_amount",
        "return_cost_amount",
        (F.col("return_retail_amount") - fee).cast("decimal(14,4)").alias("refund_amount"),
        fee.alias("restocking_fee"),
        F.col("return_delay").alias("days_since_purchase"),
        within_window(F.col("return_delay")).alias("is_within_return_window"),
        *[F.col(c).alias(f"original_{c}") for c in sales.columns if c == "transaction_nk"],
    )
