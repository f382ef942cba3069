"""Aggregates, sorts, limits, samples and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import period_start
from shelfline.functions.ratios import money_sum, rounded_percent
from shelfline.metrics.layers import METRIC_VIEW
from shelfline.metrics.predicates import test_column
from shelfline.metrics.query import aggregate
from shelfline.operators import aggregates, sampling
from shelfline.operators.distinct_sets import dictionary, grouping_set_sizes, set_sizes, sets_of, with_numbers
from shelfline.plans.reports import sold_and_returned
from shelfline.sources.readers import staging_view
from shelfline.sources.scratch import stored
from workload.oracle import money, units
from workload.published import (
    ATOMS,
    NET_SQL,
    RATIOS_SQL,
    RETURNED,
    SOLD,
    SOLD_AND_RETURNED,
    net_report,
    ratio_report,
    rounded,
)
from workload.registry import add, query
from workload.scans import table_name
from workload.star import Star

# --- sums and distinct counts -------------------------------------------------------

SINGLE = {
    "agg_total_net_revenue": "total_net_revenue",
    "agg_total_gross_revenue": "total_gross_revenue",
    "agg_total_cogs": "total_cogs",
    "agg_total_discount": "total_discount",
    "agg_total_quantity": "total_quantity",
    "agg_transaction_count": "transaction_count",
    "agg_unique_customers": "unique_customers",
    "agg_filtered_distinct": "return_transactions",
}


def by_year_and_channel(s: Star, metric: str) -> DataFrame:
    declared = METRIC_VIEW.metrics[metric]
    columns = {declared.measure.column, "transaction_year", "channel_sk"}
    where = None
    if declared.where:
        columns.add(declared.where.dimension)
        where = test_column(F.col(declared.where.dimension), declared.where.op, declared.where.value)
    return s.sales(*sorted(columns)).groupBy("transaction_year", "channel_sk").agg(aggregate(declared.measure, where).alias(metric))


for _name, _metric in SINGLE.items():
    add(
        _name,
        lambda s, m=_metric: by_year_and_channel(s, m),
        f"SELECT transaction_year, channel_sk, {ATOMS[_metric]} AS {_metric} FROM c_sales GROUP BY 1, 2",
    )


@query("agg_group_by_all", f"SELECT channel_sk, return_flag, {units('quantity_sold')} AS units, count(*) AS line_count FROM c_lines GROUP BY ALL")
def group_by_all(s: Star) -> DataFrame:
    name = table_name("sales_lines")
    staging_view(s.sales("channel_sk", "return_flag", "quantity_sold"), name)
    return s.spark.sql(
        f"""SELECT channel_sk, return_flag, CAST(sum(quantity_sold) AS BIGINT) AS units, count(1) AS line_count
        FROM {name} GROUP BY ALL"""
    )


# --- subtotals --------------------------------------------------------------------------

PRODUCT = ("division_name", "category_name", "subcategory_name")


def product_lines(s: Star, *columns: str) -> DataFrame:
    return s.star_sales("transaction_year", *columns, product=PRODUCT)


FROM_PRODUCTS = "FROM c_sales JOIN c_products USING (product_sk)"
add(
    "agg_rollup",
    lambda s: aggregates.rollup_totals(
        product_lines(s, "gross_revenue", "quantity_sold"), PRODUCT, ["gross_revenue"], ["quantity_sold"]
    ),
    f"""SELECT {', '.join(PRODUCT)}, {money("gross_revenue")} AS gross_revenue, {units("quantity_sold")} AS quantity_sold
{FROM_PRODUCTS} GROUP BY ROLLUP ({', '.join(PRODUCT)})""",
)
SETS = (("transaction_year",), ("transaction_year", "division_name"), ("division_name", "category_name"), ())
SETS_SQL = "GROUPING SETS ((transaction_year), (transaction_year, division_name), (division_name, category_name), ())"
SET_KEYS = "transaction_year, division_name, category_name"
add(
    "agg_grouping_sets",
    lambda s: aggregates.grouping_set_totals(product_lines(s, "gross_revenue"), SETS, ["gross_revenue"]),
    f"SELECT {SET_KEYS}, {money('gross_revenue')} AS gross_revenue {FROM_PRODUCTS} GROUP BY {SETS_SQL}",
)
FLAGGED = {"transaction_year": "year_rolled_up", "division_name": "division_rolled_up", "category_name": "category_rolled_up"}
add(
    "agg_grouping_flags",
    lambda s: aggregates.grouping_set_totals(
        product_lines(s, "quantity_sold"), SETS, [], ["quantity_sold"], FLAGGED
    ),
    f"""SELECT {SET_KEYS}, {', '.join(f"CAST(grouping({k}) AS INTEGER) AS {f}" for k, f in FLAGGED.items())},
  {units("quantity_sold")} AS quantity_sold {FROM_PRODUCTS} GROUP BY {SETS_SQL}""",
)


@query(
    "agg_ratio_within_grouping_sets",
    f"""SELECT {SET_KEYS}, {money("gross_margin")} AS gross_margin, {money("net_revenue_usd")} AS net_revenue_usd,
  {rounded("sum(gross_margin)", "sum(net_revenue_usd)", " * 100")} AS gm_pct {FROM_PRODUCTS} GROUP BY {SETS_SQL}""",
)
def ratio_in_sets(s: Star) -> DataFrame:
    totals = aggregates.grouping_set_totals(
        product_lines(s, "gross_margin", "net_revenue_usd"), SETS, ["gross_margin", "net_revenue_usd"]
    )
    return totals.withColumn("gm_pct", rounded_percent(F.col("gross_margin"), F.col("net_revenue_usd")))


# --- averages and ratios ------------------------------------------------------------------

add(
    "agg_avg",
    lambda s: s.inventory().groupBy("snapshot_date").agg(F.avg("on_hand_qty").alias("avg_on_hand")),
    "SELECT snapshot_date, CAST(sum(on_hand_qty) AS DOUBLE) / count(*) AS avg_on_hand FROM c_inventory GROUP BY 1",
)
add("agg_two_stage_ratio", ratio_report, RATIOS_SQL)
add(
    "agg_preaggregate_before_join",
    lambda s: sold_and_returned(s.sales(*SOLD), s.returns(*RETURNED)),
    f"SELECT * FROM {SOLD_AND_RETURNED}",
)
add("agg_net_after_returns", net_report, NET_SQL)

# --- keys per group -------------------------------------------------------------------------


@query(
    "agg_collect_per_group",
    """SELECT store_sk, (n - 1) // 4 AS page, string_agg(CAST(employee_sk AS VARCHAR), ',' ORDER BY employee_sk) AS employee_keys
FROM (SELECT store_sk, employee_sk, row_number() OVER (PARTITION BY store_sk ORDER BY employee_sk) AS n FROM c_employees
  WHERE is_active) GROUP BY 1, 2""",
)
def collect_per_group(s: Star) -> DataFrame:
    pages = aggregates.key_pages(s.employees().where("is_active"), "store_sk", "employee_sk", page_size=4)
    text = F.concat_ws(",", F.col("keys").cast("array<string>"))
    return pages.select("store_sk", "page", text.alias("employee_keys"))


add(
    "agg_first_per_group",
    lambda s: aggregates.first_per_group(s.employees().where("is_active"), "store_sk", "employee_sk", "first_employee"),
    "SELECT store_sk, min(employee_sk) AS first_employee FROM c_employees WHERE is_active GROUP BY 1",
)
add(
    "agg_distinct_keys",
    lambda s: aggregates.distinct_keys(s.sales("customer_sk"), "customer_sk"),
    "SELECT DISTINCT customer_sk FROM c_lines WHERE customer_sk IS NOT NULL",
)


@query(
    "agg_latest_snapshot",
    f"""SELECT snapshot_date, store_sk, {units("on_hand_qty")} AS on_hand, {money("inventory_cost_value")} AS cost_value
FROM c_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM c_inventory) GROUP BY 1, 2""",
)
def latest_snapshot(s: Star) -> DataFrame:
    return aggregates.latest_rows(s.stored_inventory("snapshot_date"), "snapshot_date").groupBy("snapshot_date", "store_sk").agg(
        F.sum("on_hand_qty").cast("bigint").alias("on_hand"), money_sum("inventory_cost_value").alias("cost_value")
    )


# --- sorts, limits, samples -------------------------------------------------------------------

MONTHLY = f"""SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, {money("net_revenue_usd")} AS revenue,
  {units("quantity_sold")} AS units FROM c_sales GROUP BY 1"""


def monthly(s: Star) -> DataFrame:
    sales = s.sales("transaction_date", "net_revenue_usd", "quantity_sold")
    return sales.groupBy(F.trunc("transaction_date", "month").alias("month")).agg(
        money_sum("net_revenue_usd").alias("revenue"), F.sum("quantity_sold").cast("bigint").alias("units")
    )


add("sort_metric_result", lambda s: monthly(s).orderBy("month"), f"{MONTHLY} ORDER BY month")
add(
    "limit_preview",
    lambda s: monthly(s).orderBy(F.desc("revenue"), "month").limit(20),
    f"SELECT * FROM ({MONTHLY}) ORDER BY revenue DESC, month LIMIT 20",
)
add(
    "sample_fraction",
    lambda s: sampling.sample_percent(s.sales("transaction_sk", "product_sk", "quantity_sold"), F.col("transaction_sk"), 8),
    "SELECT transaction_sk, product_sk, quantity_sold FROM c_lines WHERE transaction_sk % 100 < 8",
)
add(
    "sample_n",
    lambda s: sampling.sample_rows(s.products("product_sk", "product_nk"), "product_sk", 500),
    "SELECT product_sk, product_nk FROM c_products ORDER BY md5(CAST(product_sk AS VARCHAR)), product_sk LIMIT 500",
)

# --- set operations ----------------------------------------------------------------------------


@query(
    "set_union_all",
    """SELECT 'sale' AS kind, transaction_date_sk AS day_sk, product_sk, CAST(quantity_sold AS BIGINT) AS units FROM c_lines
UNION ALL SELECT 'return', return_date_sk, product_sk, CAST(quantity_returned AS BIGINT) FROM c_returns""",
)
def union_all(s: Star) -> DataFrame:
    def shaped(df: DataFrame, kind: str, day: str, quantity: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), F.col(day).alias("day_sk"), "product_sk", F.col(quantity).cast("bigint").alias("units")
        )

    sold = shaped(s.sales("transaction_date_sk", "product_sk", "quantity_sold"), "sale", "transaction_date_sk", "quantity_sold")
    back = shaped(s.returns("return_date_sk", "product_sk", "quantity_returned"), "return", "return_date_sk", "quantity_returned")
    return sold.unionByName(back)


add(
    "set_difference",
    lambda s: s.customers("customer_sk").subtract(s.sales("customer_sk").distinct()),
    "SELECT customer_sk FROM c_customers EXCEPT SELECT customer_sk FROM c_lines",
)
add(
    "set_distinct",
    lambda s: s.returns("product_sk", "return_reason_code").distinct(),
    "SELECT DISTINCT product_sk, return_reason_code FROM c_returns",
)


# --- distinct counts from merged sets -----------------------------------------------------------


def daily_customer_sets(s: Star) -> DataFrame:
    """The customers of each channel and day, read from the facts once and stored."""
    sales = s.sales("customer_sk", "channel_sk", "transaction_date")
    return stored(sets_of(sales, ["channel_sk", "transaction_date"], "customer_sk"), "customer_sets")


PERIODS = ("day", "week", "month", "quarter", "year")


@query(
    "agg_distinct_over_days",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS grain, channel_sk, CAST(date_trunc('{p}', transaction_date) AS DATE) AS period_start,
  count(DISTINCT customer_sk) AS customers FROM c_lines WHERE customer_sk IS NOT NULL GROUP BY 2, 3"""
        for p in PERIODS
    ),
)
def distinct_over_days(s: Star) -> DataFrame:
    """Customers by channel and day, week, month, quarter and year, all from the sets of days."""
    sets = daily_customer_sets(s)
    parts = []
    for grain in PERIODS:
        keys = {"channel_sk": F.col("channel_sk"), "period_start": period_start(F.col("transaction_date"), grain)}
        parts.append(set_sizes(sets, keys, "customers").withColumn("grain", F.lit(grain)))
    return reduce(DataFrame.unionByName, parts)


@query(
    "agg_distinct_rollup",
    """SELECT transaction_year, channel_sk, return_flag, CAST(grouping(channel_sk) AS INTEGER) AS all_channels,
  CAST(grouping(return_flag) AS INTEGER) AS all_flags, count(DISTINCT transaction_id) AS transactions
FROM c_lines GROUP BY ROLLUP (transaction_year, channel_sk, return_flag)""",
)
def distinct_rollup(s: Star) -> DataFrame:
    """Transactions, whose ids are texts, at every level of a rollup: the finest sets are merged upwards."""
    keys = ["transaction_year", "channel_sk", "return_flag"]
    lines = stored(s.lines("transaction_id", *keys), "lines")
    sets = sets_of(with_numbers(lines, dictionary(lines, "transaction_id"), "transaction_id"), keys, "number")
    levels = [keys[:n] for n in range(3, -1, -1)]
    return grouping_set_sizes(sets, levels, "transactions", {"channel_sk": "all_channels", "return_flag": "all_flags"})
