"""One-row KPI summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.ratios import money_sum, percent, ratio, unit_sum
from shelfline.operators.aggregates import latest_rows


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def kpi_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(
        money_sum("gross_revenue").alias("total_gross_revenue"),
        money_sum("discount_amount").alias("total_discounts"),
        money_sum("net_revenue").alias("total_net_revenue"),
        money_sum("cost_of_goods_sold").alias("total_cogs"),
        money_sum("gross_margin").alias("total_gross_margin"),
    )


def kpi_profitability(sales: DataFrame) -> DataFrame:
    totals = sales.agg(
        money_sum("gross_margin").alias("_margin"),
        money_sum("net_revenue").alias("_net"),
        money_sum("discount_amount").alias("_discount"),
        money_sum("gross_revenue").alias("_gross"),
        F.count_distinct("transaction_id").alias("transaction_count"),
    )
    return totals.select(
        _or_zero(percent(F.col("_margin"), F.col("_net"))).alias("gross_margin_pct"),
        _or_zero(percent(F.col("_discount"), F.col("_gross"))).alias("discount_rate_pct"),
        _or_zero(ratio(F.col("_net"), F.col("transaction_count"))).alias("avg_order_value"),
        "transaction_count",
    )


def kpi_returns(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """The two facts are counted apart and folded into one row without a join."""
    counted = sales.agg(F.count(F.lit(1)).alias("sale_lines")).unionByName(
        returns.agg(F.count(F.lit(1)).alias("return_lines"), money_sum("refund_amount").alias("total_refunds")),
        allowMissingColumns=True,
    )
    folded = counted.agg(*[F.max(c).alias(c) for c in ("sale_lines", "return_lines", "total_refunds")])
    return folded.select(
        "return_lines",
        "total_refunds",
        percent(F.col("return_lines"), F.col("sale_lines")).alias("return_rate_pct"),
    )


def kpi_digital(sessions: DataFrame) -> DataFrame:
    counted = sessions.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("bounce_flag").alias("_bounced"),
        F.count_if("purchase_completed_flag").alias("_bought"),
    )
    return counted.select(
        "sessions",
        _or_zero(percent(F.col("_bounced"), F.col("sessions"))).alias("bounce_rate_pct"),
        _or_zero(percent(F.col("_bought"), F.col("sessions"))).alias("conversion_rate_pct"),
    )


def kpi_inventory(snapshots: DataFrame) -> DataFrame:
    """Totals of the latest snapshot date."""
    latest = latest_rows(snapshots, "snapshot_date_sk")
    counted = latest.agg(
        unit_sum("on_hand_qty").alias("total_on_hand"),
        F.count_if(F.col("stockout_flag") == "Y").alias("stockout_count"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return counted.select(
        "total_on_hand",
        "stockout_count",
        percent(F.col("stockout_count"), F.col("_rows")).alias("stockout_rate_pct"),
    )
