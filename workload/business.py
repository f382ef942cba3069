"""Dimensions, facts and the row rules behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.ratios import unit_sum
from shelfline.operators.joins import many_to_one
from shelfline.rules import calendar, pricing, promotions, stores
from shelfline.schemas import TABLES
from workload.oracle import calendar_sql, key60, units, whole_sql
from workload.registry import add, query
from workload.star import Star

# --- dimensions ------------------------------------------------------------------------

SPAN = """(SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""
DATE_OUT = TABLES["dim_date"].column_names


def ordered_days(s: Star) -> DataFrame:
    return calendar.days_of(s.raw("orders").select(F.col("o_orderdate").cast("date").alias("_day")), "_day")


add(
    "build_dim_date",
    lambda s: calendar.build_dim_date(ordered_days(s)),
    f"SELECT {', '.join(DATE_OUT)} FROM ({calendar_sql(SPAN)})",
)


def whole_table(name: str, table: str, source: str) -> None:
    """A built table with all its declared columns and types."""
    add(name, lambda s: s.declared(table), whole_sql(table, source))


whole_table("build_dim_store", "dim_store", "c_stores")
whole_table("build_dim_product", "dim_product", "c_products")
whole_table("build_dim_customer", "dim_customer", "c_customers")
add(
    "build_dim_employee",
    lambda s: s.employees(),
    f"SELECT {', '.join(TABLES['dim_employee'].column_names)} FROM c_employees",
)
PROMOTION_OUT = (
    "promotion_sk", "discount_type", "discount_value", "start_date", "end_date", "start_date_sk", "end_date_sk", "promotion_status"
)
add(
    "build_dim_promotion",
    lambda s: s.promotions().select(*PROMOTION_OUT, "promotion_nk", "applicable_product_category"),
    f"""SELECT {', '.join(PROMOTION_OUT)}, 'PROMO-' || lpad(CAST(promotion_sk AS VARCHAR), 5, '0') AS promotion_nk,
  p_brand AS applicable_product_category FROM c_promotions""",
)

REGION_KEY = key60("'REGION'", "region_code")
COUNTRY_KEY = key60("'COUNTRY'", "region_code", "country_code")
STATE_KEY = key60("'STATE'", "region_code", "country_code", "state_code")
CITY_KEY = key60("'CITY'", "region_code", "country_code", "state_code", "city")
GEOGRAPHY_SQL = f"""SELECT DISTINCT {REGION_KEY} AS geo_sk, 'REGION' AS geo_level, region_code AS geo_code, region_code AS geo_name,
  CAST(NULL AS BIGINT) AS parent_geo_sk, region_code AS world_region, NULL AS sub_region, NULL AS country_code, NULL AS country_name,
  NULL AS state_code, NULL AS state_name, NULL AS metro_market, NULL AS city, 'TIER_1' AS market_priority FROM c_rawstores
UNION ALL SELECT DISTINCT {COUNTRY_KEY}, 'COUNTRY', country_code, country_name, {REGION_KEY}, region_code, region_code, country_code,
  country_name, NULL, NULL, NULL, NULL, 'TIER_2' FROM c_rawstores
UNION ALL SELECT DISTINCT {STATE_KEY}, 'STATE', state_code, state_code, {COUNTRY_KEY}, region_code, region_code, country_code,
  country_name, state_code, state_code, NULL, NULL, 'TIER_2' FROM c_rawstores
UNION ALL SELECT DISTINCT {CITY_KEY}, 'CITY', state_code || '_' || upper(substr(city, 1, 3)), city, {STATE_KEY}, region_code,
  region_code, country_code, country_name, state_code, state_code, city, city, 'TIER_3' FROM c_rawstores"""
whole_table("build_dim_geography", "dim_geography", f"({GEOGRAPHY_SQL})")
add(
    "build_dim_channel",
    lambda s: many_to_one(
        stores.build_dim_channel(s.spark),
        s.sales("channel_sk", "quantity_sold").groupBy("channel_sk").agg(unit_sum("quantity_sold").alias("units")),
        "channel_sk",
    ).select("channel_sk", "channel_name", "channel_category", "channel_type", "is_digital", "is_owned", "units"),
    f"""SELECT c.*, units FROM (VALUES
  {', '.join(f"({sk}, '{stores.channel_name(sk)}', '{cat}', '{kind}', {dig}, {own})" for sk, cat, kind, dig, own in stores.CHANNELS)})
  c(channel_sk, channel_name, channel_category, channel_type, is_digital, is_owned)
  LEFT JOIN (SELECT channel_sk, {units("quantity_sold")} AS units FROM c_lines GROUP BY 1) USING (channel_sk)""",
)

# --- facts ---------------------------------------------------------------------------------

whole_table("build_fact_sales", "fact_sales_transactions", "c_promoted")
whole_table("build_fact_web_sessions", "fact_web_sessions", "c_sessions")
whole_table("returns_build", "fact_returns", "c_returns")
whole_table("inventory_snapshot_build", "fact_inventory_snapshot", "c_inventory")

# --- pricing rules -------------------------------------------------------------------------------


def fact_slice(name: str, *columns: str) -> None:
    add(
        name,
        lambda s: s.sales("transaction_sk", *columns),
        f"SELECT transaction_sk, {', '.join(columns)} FROM c_sales",
    )


fact_slice(
    "line_pricing", "quantity_sold", "gross_revenue", "discount_amount", "net_revenue", "tax_amount",
    "total_transaction_amount", "cost_of_goods_sold", "gross_margin",
)
fact_slice("line_margin_pct", "net_revenue", "gross_margin", "gross_margin_pct")
fact_slice("currency_to_usd", "currency_code", "exchange_rate", "net_revenue", "net_revenue_usd")


@query(
    "promotion_discount",
    """SELECT transaction_sk, discount_type, CAST(CASE discount_type WHEN 'PERCENT' THEN gross_revenue * discount_value * CAST(0.01 AS DECIMAL(3,2))
  WHEN 'FIXED_AMOUNT' THEN least(discount_value, gross_revenue) ELSE 0 END AS DECIMAL(12,4)) AS discount_amount
FROM c_sales LEFT JOIN c_promotions USING (promotion_sk)""",
)
def promotion_discounts(s: Star) -> DataFrame:
    """The discount each sale would get from its promotion at any date, 0 without a promotion."""
    offers = s.promotions().select("promotion_sk", "discount_type", "discount_value")
    joined = many_to_one(s.sales("transaction_sk", "promotion_sk", "gross_revenue"), offers, "promotion_sk")
    discount = pricing.promotion_discount(F.col("gross_revenue"), F.col("discount_type"), F.col("discount_value"))
    return joined.select("transaction_sk", "discount_type", discount.alias("discount_amount"))


def dated_lines(s: Star) -> DataFrame:
    """Each order line as an offer that starts on its day and runs 7 to 44 days."""
    days = (F.pmod("order_number", F.lit(38)) + 7).cast("int")
    return s.lines("transaction_sk", "transaction_date", "order_number").select("transaction_sk", promotions.clamped_end(F.col("transaction_date"), days, s.horizon).alias("end_date"))


ENDS = "least(transaction_date + CAST(order_number % 38 + 7 AS INTEGER), (SELECT horizon FROM c_span))"
add("promotion_end_clamped", dated_lines, f"SELECT transaction_sk, {ENDS} AS end_date FROM c_lines")
add(
    "promotion_status",
    lambda s: dated_lines(s).withColumn("promotion_status", promotions.status(F.col("end_date"), s.horizon)),
    f"""SELECT transaction_sk, {ENDS} AS end_date, CASE WHEN {ENDS} >= (SELECT horizon FROM c_span) THEN 'ACTIVE' ELSE 'COMPLETED' END
  AS promotion_status FROM c_lines""",
)


@query(
    "seasonality_weight",
    f"""SELECT full_date, weight_before, CAST(weight_before AS DOUBLE) / CAST(sum(weight_before) OVER () AS DOUBLE) AS weight
FROM (SELECT full_date, CAST(CASE WHEN quarter_num = 4 THEN 1.5::DOUBLE ELSE 1 END * CASE WHEN is_black_friday OR is_cyber_monday THEN 3 ELSE 1 END
  * CASE WHEN is_weekend THEN 1.2::DOUBLE ELSE 1 END * CASE WHEN is_back_to_school THEN 1.3::DOUBLE ELSE 1 END AS DECIMAL(12,4)) AS weight_before
FROM ({calendar_sql(SPAN)}))""",
)
def seasonality(s: Star) -> DataFrame:
    dates = calendar.build_dim_date(ordered_days(s))
    return calendar.seasonality(dates).select("full_date", F.col("raw_weight").alias("weight_before"), "weight")


# --- inventory, returns and session rules ------------------------------------------------------------


def stock_slice(name: str, *columns: str) -> None:
    names = ("product_sk", "store_sk", "snapshot_date_sk", *columns)
    add(name, lambda s: s.inventory().select(*names), f"SELECT {', '.join(names)} FROM c_inventory")


stock_slice("inventory_positions", "on_hand_qty", "reserved_qty", "available_to_sell_qty", "inventory_cost_value", "inventory_retail_value")
stock_slice("inventory_health", "days_of_supply", "stock_turn_rate", "stockout_flag")


def return_slice(name: str, *columns: str) -> None:
    add(name, lambda s: s.returns("return_sk", *columns), f"SELECT return_sk, {', '.join(columns)} FROM c_returns")


return_slice("returns_refund", "return_reason_code", "return_condition", "return_retail_amount", "restocking_fee", "refund_amount")
return_slice("returns_window_flag", "days_since_purchase", "is_within_return_window")

FUNNEL_OUT = (
    "session_sk", "session_date_sk", "session_duration_seconds", "pages_viewed", "products_viewed", "products_added_to_cart",
    "cart_value", "checkout_initiated_flag", "purchase_completed_flag", "bounce_flag",
)
add("session_funnel", lambda s: s.funnels().select(*FUNNEL_OUT), f"SELECT {', '.join(FUNNEL_OUT)} FROM c_funnels")


def session_slice(name: str, *columns: str) -> None:
    names = ("session_sk", *columns)
    add(name, lambda s: s.sessions().select(*names), f"SELECT {', '.join(names)} FROM c_sessions")


session_slice("session_bounce_exit", "bounce_flag", "entry_page", "exit_page", "traffic_source", "campaign_id")
session_slice("session_platform", "device_type", "os_platform", "browser_name")
add(
    "customer_ltv_band",
    lambda s: s.customers("customer_sk", "loyalty_tier", "lifetime_value_band"),
    "SELECT customer_sk, loyalty_tier, lifetime_value_band FROM c_bands",
)
