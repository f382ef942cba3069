"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.ratios import money_sum, unit_sum
from shelfline.metrics.layers import SEMANTIC_LAYER
from shelfline.metrics.query import with_entities
from shelfline.operators import joins, windows
from shelfline.operators.hierarchy import with_ancestors
from shelfline.plans.reports import sold_and_returned
from shelfline.rules import inventory, sessions, stores
from workload.oracle import money
from workload.published import RETURNED, SOLD, SOLD_AND_RETURNED
from workload.registry import add, query
from workload.star import Star


@query(
    "join_star_inner",
    """SELECT transaction_sk, year_num, quarter_name, division_name, category_name, region_name, gross_revenue
FROM c_sales f JOIN c_dates d ON d.date_sk = f.transaction_date_sk JOIN c_products p ON p.product_sk = f.product_sk
JOIN c_stores s ON s.store_sk = f.store_sk""",
)
def star_inner(s: Star) -> DataFrame:
    sales = s.sales("transaction_sk", "transaction_date_sk", "product_sk", "store_sk", "gross_revenue")
    return joins.star_inner(
        sales,
        (s.dates("date_sk", "year_num", "quarter_name"), "transaction_date_sk", "date_sk"),
        (s.products("product_sk", "division_name", "category_name"), "product_sk", "product_sk"),
        (s.stores("store_sk", "region_name"), "store_sk", "store_sk"),
    ).select("transaction_sk", "year_num", "quarter_name", "division_name", "category_name", "region_name", "gross_revenue")


@query(
    "join_many_to_one",
    """SELECT transaction_sk, store_name, region_name, product_name FROM c_sales LEFT JOIN c_stores USING (store_sk)
LEFT JOIN c_products USING (product_sk)""",
)
def many_to_one(s: Star) -> DataFrame:
    located = joins.many_to_one(
        s.sales("transaction_sk", "store_sk", "product_sk"), s.stores("store_sk", "store_name", "region_name"), "store_sk"
    )
    named = joins.many_to_one(located, s.products("product_sk", "product_name"), "product_sk")
    return named.select("transaction_sk", "store_name", "region_name", "product_name")


@query(
    "join_entity",
    """SELECT transaction_sk, region_name AS store__region_name, category_name AS product__category_name,
  customer_segment AS customer__customer_segment, loyalty_tier AS customer__loyalty_tier
FROM c_sales LEFT JOIN c_stores USING (store_sk) LEFT JOIN c_products USING (product_sk)
LEFT JOIN c_customers USING (customer_sk)""",
)
def entity(s: Star) -> DataFrame:
    wanted = {"store": ["region_name"], "product": ["category_name"], "customer": ["customer_segment", "loyalty_tier"]}
    sales = s.sales("transaction_sk", "store_sk", "product_sk", "customer_sk")
    joined = with_entities(SEMANTIC_LAYER, s.metric_sources(), sales, wanted)
    names = [F.col(f"_{e}_{c}").alias(f"{e}__{c}") for e, columns in wanted.items() for c in columns]
    return joined.select("transaction_sk", *names)


add(
    "join_left_composite",
    lambda s: sold_and_returned(s.sales(*SOLD), s.returns(*RETURNED)),
    f"SELECT * FROM {SOLD_AND_RETURNED}",
)


@query(
    "join_range_promotion",
    """SELECT transaction_sk, r.promotion_sk, r.discount_type FROM c_lines l LEFT JOIN c_promotions r
  ON l.promotion_sk = r.promotion_sk AND l.transaction_date BETWEEN r.start_date AND r.end_date""",
)
def range_promotion(s: Star) -> DataFrame:
    sales = s.sales("transaction_sk", "transaction_date", "promotion_sk")
    return joins.valid_promotion(sales, s.promotions(), keep=("discount_type",)).select(
        "transaction_sk", "promotion_sk", "discount_type"
    )


add(
    "join_anti_orphans",
    lambda s: joins.orphans(s.sales("employee_sk"), "employee_sk", s.employees().where("is_active"), "employee_sk"),
    """SELECT DISTINCT employee_sk AS orphan_key FROM c_lines WHERE employee_sk IS NOT NULL
AND employee_sk NOT IN (SELECT employee_sk FROM c_employees WHERE is_active)""",
)

add(
    "join_semi_flag",
    lambda s: joins.flag_matches(
        s.sales("transaction_sk", "transaction_nk"), s.returns("original_transaction_nk"),
        "transaction_nk", "original_transaction_nk", "return_flag",
    ).drop("transaction_nk"),
    """SELECT transaction_sk, CASE WHEN transaction_sk IN (SELECT original_transaction_sk FROM c_returns) THEN 'Y' ELSE 'N' END
  AS return_flag FROM c_lines""",
)


def channel_days(s: Star) -> DataFrame:
    """Units per channel and day; some channels have days without sales."""
    sales = s.sales("channel_sk", "transaction_date", "quantity_sold")
    return sales.groupBy("channel_sk", F.col("transaction_date").alias("date_day")).agg(
        unit_sum("quantity_sold").alias("units")
    )


CHANNEL_DAYS = "(SELECT channel_sk, transaction_date AS date_day, CAST(sum(quantity_sold) AS BIGINT) AS units FROM c_lines GROUP BY 1, 2)"
CHANNEL_SPINE = f"""(SELECT channel_sk, date_day FROM (SELECT DISTINCT channel_sk FROM {CHANNEL_DAYS})
  CROSS JOIN (SELECT CAST(unnest(generate_series(CAST(min(date_day) AS TIMESTAMP), CAST(max(date_day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
    AS date_day FROM {CHANNEL_DAYS}))"""


@query(
    "join_time_spine",
    f"SELECT channel_sk, date_day, units FROM {CHANNEL_SPINE} LEFT JOIN {CHANNEL_DAYS} USING (channel_sk, date_day)",
)
def time_spine(s: Star) -> DataFrame:
    return windows.fill_days(channel_days(s), "date_day", ["channel_sk"])


add(
    "join_offset",
    lambda s: joins.offset_by_days(channel_days(s), "date_day", "units", 1, "units_day_before", ["channel_sk"]),
    f"""SELECT a.channel_sk, a.date_day, a.units, b.units AS units_day_before FROM {CHANNEL_DAYS} a
LEFT JOIN {CHANNEL_DAYS} b ON a.channel_sk = b.channel_sk AND b.date_day = a.date_day - 1""",
)


@query(
    "join_metric_results",
    f"""SELECT coalesce(a.customer_sk, b.customer_sk) AS customer_sk, coalesce(a.day_sk, b.day_sk) AS day_sk, revenue, refunds
FROM (SELECT customer_sk, transaction_date_sk AS day_sk, {money("net_revenue_usd")} AS revenue FROM c_sales GROUP BY 1, 2) a
FULL JOIN (SELECT customer_sk, return_date_sk AS day_sk, {money("refund_amount")} AS refunds FROM c_returns GROUP BY 1, 2) b
  ON a.customer_sk IS NOT DISTINCT FROM b.customer_sk AND a.day_sk = b.day_sk""",
)
def metric_results(s: Star) -> DataFrame:
    sold = s.sales("customer_sk", "transaction_date_sk", "net_revenue_usd").groupBy(
        "customer_sk", F.col("transaction_date_sk").alias("day_sk")
    ).agg(money_sum("net_revenue_usd").alias("revenue"))
    back = s.returns("customer_sk", "return_date_sk", "refund_amount").groupBy(
        "customer_sk", F.col("return_date_sk").alias("day_sk")
    ).agg(money_sum("refund_amount").alias("refunds"))
    return joins.merge_results([sold, back], ["customer_sk", "day_sk"])


PLACES_SQL = """
  SELECT DISTINCT 'CITY' AS geo_level, city AS geo_name, state_code AS parent_1_name, country_name AS parent_2_name,
    region_code AS parent_3_name FROM c_rawstores
  UNION ALL SELECT DISTINCT 'STATE', state_code, country_name, region_code, NULL FROM c_rawstores
  UNION ALL SELECT DISTINCT 'COUNTRY', country_name, region_code, NULL, NULL FROM c_rawstores
  UNION ALL SELECT DISTINCT 'REGION', region_code, NULL, NULL, NULL FROM c_rawstores"""


@query("join_parent_hierarchy", PLACES_SQL)
def parent_hierarchy(s: Star) -> DataFrame:
    walked = with_ancestors(stores.build_dim_geography(s.raw_stores()), levels=3)
    return walked.select("geo_level", "geo_name", "parent_1_name", "parent_2_name", "parent_3_name")


@query(
    "join_cross_grid",
    """SELECT store_sk, week_day, count(*) AS items FROM (SELECT product_sk, store_sk,
  CAST(unnest(generate_series(CAST(min(move_date) AS TIMESTAMP), (SELECT CAST(last_day AS TIMESTAMP) FROM c_span), INTERVAL 7 DAY)) AS DATE) AS week_day
  FROM c_moves GROUP BY 1, 2) GROUP BY 1, 2""",
)
def weekly_grid(s: Star) -> DataFrame:
    """Every seventh day of each stocked pair, counted per site and day."""
    grid = inventory.snapshot_grid(s.movements(), ["product_sk", "store_sk"], "move_date", s.calendar_end, "week")
    return grid.groupBy("store_sk", F.col("move_date").alias("week_day")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "join_return_to_sale",
    """SELECT return_sk, f.transaction_date, f.unit_retail_price, f.net_revenue, r.quantity_returned, r.refund_amount
FROM c_returns r JOIN c_sales f ON f.transaction_sk = r.original_transaction_sk""",
)
def return_to_sale(s: Star) -> DataFrame:
    sold = s.sales("transaction_nk", "transaction_date", "unit_retail_price", "net_revenue")
    back = s.returns("return_sk", "original_transaction_nk", "quantity_returned", "refund_amount")
    return back.join(sold, F.col("original_transaction_nk") == F.col("transaction_nk")).select(
        "return_sk", "transaction_date", "unit_retail_price", "net_revenue", "quantity_returned", "refund_amount"
    )


@query(
    "join_backfill_manager",
    """SELECT s.store_sk, store_name, min(employee_sk) AS store_manager_employee_sk FROM c_stores s
LEFT JOIN c_employees e ON e.store_sk = s.store_sk AND e.is_active GROUP BY 1, 2""",
)
def backfill_manager(s: Star) -> DataFrame:
    active = s.employees().where("is_active")
    return joins.with_first_match(
        s.stores("store_sk", "store_name"), active, "store_sk", "employee_sk", "store_manager_employee_sk"
    )


ATTRIBUTED = "session_sk, session_date, purchase_completed_flag, purchase_transaction_sk, purchase_revenue"
add(
    "join_conversion_attribution",
    lambda s: sessions.attribute_conversions(s.funnels(), s.digital_sales()).select(*ATTRIBUTED.split(", ")),
    f"SELECT {ATTRIBUTED} FROM c_attributed",
)
