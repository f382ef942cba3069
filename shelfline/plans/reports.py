"""Five KPI reports over the star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.ratios import money_sum, ratio, round_half_up, rounded_percent, unit_sum
from shelfline.operators.aggregates import grouping_set_totals, rollup_totals
from shelfline.operators.filters import at_period_end
from shelfline.operators.joins import left_composite, star_inner

KEPT = "return_flag = 'N'"


def _star(
    sales: DataFrame, dates: DataFrame, products: DataFrame | None, stores: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """Sales joined with the named attributes. A product or store frame that is
    None means that the sales already carry those attributes."""
    edges = [(dates, "transaction_date_sk", "date_sk")]
    edges += [(products, "product_sk", "product_sk")] if products is not None else []
    edges += [(stores, "store_sk", "store_sk")] if stores is not None else []
    wanted = [(d.select(pk, *[k for k in keys if k in d.columns]), fk, pk) for d, fk, pk in edges]
    return star_inner(sales.where(KEPT), *wanted)


def revenue_rollup(
    sales: DataFrame, dates: DataFrame, products: DataFrame | None = None, stores: DataFrame | None = None
) -> DataFrame:
    """Additive totals rolled up over time, product and place."""
    keys = ["year_num", "quarter_name", "month_name", "division_name", "category_name", "region_name", "country_name"]
    star = _star(sales, dates, products, stores, keys)
    totals = rollup_totals(
        star, keys,
        money=["net_revenue_usd", "gross_revenue", "discount_amount", "cost_of_goods_sold", "gross_margin"],
        units=["quantity_sold"],
    )
    return totals.select(
        *keys,
        F.col("net_revenue_usd").alias("total_net_revenue"),
        F.col("quantity_sold").alias("total_units_sold"),
        F.col("gross_revenue").alias("total_gross_revenue"),
        F.col("discount_amount").alias("total_discount"),
        F.col("cost_of_goods_sold").alias("total_cogs"),
        F.col("gross_margin").alias("total_gross_margin"),
    )


def period_end_inventory(inventory: DataFrame, dates: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Stock on the last day of each month; stock never adds up over days."""
    month_ends = dates.where(at_period_end(F.col("full_date"))).select("date_sk", "month_year")
    star = star_inner(
        inventory,
        (month_ends, "snapshot_date_sk", "date_sk"),
        (products.select("product_sk", "category_name", "subcategory_name"), "product_sk", "product_sk"),
        (stores.select("store_sk", "region_name"), "store_sk", "store_sk"),
    )
    return star.groupBy("month_year", "category_name", "subcategory_name", "region_name").agg(
        unit_sum("on_hand_qty").alias("period_end_on_hand"),
        unit_sum("available_to_sell_qty").alias("period_end_ats"),
        money_sum("inventory_cost_value").alias("period_end_cost_value"),
        money_sum("inventory_retail_value").alias("period_end_retail_value"),
        F.avg("on_hand_qty").alias("avg_daily_on_hand"),
    )


def non_additive_ratios(
    sales: DataFrame, dates: DataFrame, products: DataFrame | None = None, stores: DataFrame | None = None
) -> DataFrame:
    """Ratios of sums by quarter, category and region."""
    keys = ["year_num", "quarter_name", "category_name", "region_name"]
    sums = _star(sales, dates, products, stores, keys).groupBy(*keys).agg(
        money_sum("net_revenue_usd").alias("net_revenue"),
        money_sum("gross_revenue").alias("gross_revenue"),
        money_sum("gross_margin").alias("gross_margin"),
        money_sum("cost_of_goods_sold").alias("cogs"),
        money_sum("discount_amount").alias("total_discount"),
        F.count_distinct("transaction_id").alias("num_transactions"),
        unit_sum("quantity_sold").alias("units_sold"),
    )
    per_transaction = F.col("num_transactions")
    return sums.withColumns(
        {
            "gross_margin_pct": rounded_percent(F.col("gross_margin"), F.col("net_revenue")),
            "discount_rate_pct": rounded_percent(F.col("total_discount"), F.col("gross_revenue")),
            "avg_transaction_value": round_half_up(ratio(F.col("net_revenue"), per_transaction), 2),
            "avg_selling_price": round_half_up(ratio(F.col("net_revenue"), F.col("units_sold")), 2),
            "avg_units_per_transaction": round_half_up(ratio(F.col("units_sold"), per_transaction), 2),
        }
    )


DATE_LEVELS = ("year_num", "quarter_name", "month_name", "full_date")
PRODUCT_LEVELS = ("division_name", "category_name", "subcategory_name", "product_line_name")

# Names of the subtotal markers. The marker of the day level keeps
# its published name although it is 1 where the day is rolled up.
LEVEL_FLAGS = {
    "year_num": "is_year_total",
    "quarter_name": "is_quarter_total",
    "month_name": "is_month_total",
    "full_date": "is_day_level",
    "division_name": "is_division_total",
    "category_name": "is_category_total",
    "subcategory_name": "is_subcategory_total",
    "product_line_name": "is_product_line_total",
}


def hierarchy_drill(sales: DataFrame, dates: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Revenue at each level of the date and product hierarchies and at one mix of both."""
    star = _star(sales, dates, products, None, [*DATE_LEVELS, *PRODUCT_LEVELS])
    sets = [DATE_LEVELS[: n + 1] for n in range(4)] + [PRODUCT_LEVELS[: n + 1] for n in range(4)]
    sets.append(("year_num", "division_name", "category_name"))
    totals = grouping_set_totals(star, sets, ["net_revenue_usd", "gross_margin"], ["quantity_sold"], LEVEL_FLAGS)
    return totals.select(
        *LEVEL_FLAGS.values(),
        *DATE_LEVELS,
        *PRODUCT_LEVELS,
        F.col("net_revenue_usd").alias("net_revenue"),
        F.col("quantity_sold").alias("units_sold"),
        "gross_margin",
        rounded_percent(F.col("gross_margin"), F.col("net_revenue_usd")).alias("gm_pct"),
    )


def sold_and_returned(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Both facts summed to product and day, then joined; refunds of days on
    which the product did not sell have no row to join."""
    sold = sales.where(KEPT).groupBy("product_sk", "transaction_date_sk").agg(
        money_sum("net_revenue_usd").alias("gross_net_revenue"), unit_sum("quantity_sold").alias("units_sold")
    )
    back = returns.groupBy("product_sk", F.col("return_date_sk").alias("transaction_date_sk")).agg(
        money_sum("refund_amount").alias("total_refunds"), unit_sum("quantity_returned").alias("units_returned")
    )
    return left_composite(sold, back, ["product_sk", "transaction_date_sk"], ["total_refunds", "units_returned"])


def net_after_returns(sales: DataFrame, returns: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    star = star_inner(
        sold_and_returned(sales, returns),
        (products.select("product_sk", "category_name"), "product_sk", "product_sk"),
        (dates.select("date_sk", "year_num", "quarter_name"), "transaction_date_sk", "date_sk"),
    )
    totals = star.groupBy("category_name", "year_num", "quarter_name").agg(
        money_sum("gross_net_revenue").alias("gross_net_revenue"),
        money_sum("total_refunds").alias("total_refunds"),
        unit_sum("units_sold").alias("units_sold"),
        unit_sum("units_returned").alias("units_returned"),
    )
    return totals.withColumns(
        {
            "net_revenue_after_returns": (F.col("gross_net_revenue") - F.col("total_refunds")).cast("decimal(24,4)"),
            "return_rate_pct": rounded_percent(F.col("units_returned"), F.col("units_sold")),
        }
    )
