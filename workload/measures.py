"""The metric layer."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.metrics.catalog import lookup_terms, metric_catalog
from shelfline.metrics.formatting import format_value
from shelfline.metrics.layers import CUSTOMERS, METRIC_VIEW, NET, SEMANTIC_LAYER, TRANSACTIONS
from shelfline.metrics.model import Condition, Derived, Input, Layer, Simple
from shelfline.metrics.query import metric_query
from shelfline.sources.readers import read_parquet
from shelfline.sources.scratch import scratch_folder, stored
from shelfline.sources.writers import nullable, write_parquet
from workload.declared import entry_rows, formatted, shown_sql
from workload.oracle import money
from workload.published import ATOMS, D244, FROM_STAR, LAST_1, MONTH, SO_FAR, SPINE, daily_sql, over, plain_sql, spine_over
from workload.registry import add, query
from workload.star import Star


def metric(name: str, metrics: str, oracle_keys: str, group_by: str, layer: Layer = METRIC_VIEW) -> None:
    names = metrics.split(",")
    add(
        name,
        lambda s: metric_query(layer, s.metric_sources(), names, group_by.split(",")),
        plain_sql(oracle_keys, {m: m for m in names}),
    )


metric("metric_simple", "total_net_revenue,total_quantity,unique_customers", "country_name, gender_target", "country_name,gender_target")
metric("metric_filtered", "return_transactions,transaction_count", "country_name, division_name", "country_name,division_name")
metric("metric_composed", "gross_margin,avg_order_value,return_rate", "store_format, category_name", "store_format,category_name")
for _name in ("gross_margin", "gross_margin_pct", "avg_order_value", "avg_selling_price", "discount_rate", "return_rate"):
    metric(f"metric_{_name}", _name, "region_name, category_name", "region_name,category_name")
for _grain in ("day", "week", "month", "quarter", "year"):
    metric(
        f"metric_time_grain_{_grain}" if _grain != "month" else "metric_time_grain",
        "total_net_revenue,transaction_count",
        f"region_name AS store__region_name, CAST(date_trunc('{_grain}', transaction_date) AS DATE) AS metric_time__{_grain}",
        f"store__region_name,metric_time__{_grain}",
        SEMANTIC_LAYER,
    )
metric(
    "metric_dimension_alias", "total_quantity",
    """store_name, region_name, country_name, store_format, division_name, category_name, product_name, gender_target,
  revenue_tier, transaction_year""",
    """store_name,region_name,country_name,store_format,division_name,category_name,product_name,gender_target,revenue_tier,transaction_year""",
)


@query(
    "metric_dimension_alias_customer",
    f"""SELECT loyalty_tier AS customer__loyalty_tier, customer_segment AS customer__customer_segment,
  gender_code AS customer__gender_code, lifetime_value_band AS customer__lifetime_value_band,
  currency_code AS transaction__currency_code, {ATOMS["total_net_revenue"]} AS total_net_revenue
FROM c_sales LEFT JOIN c_customers USING (customer_sk) GROUP BY ALL""",
)
def customer_attributes(s: Star) -> DataFrame:
    keys = ["customer__loyalty_tier", "customer__customer_segment", "customer__gender_code",
            "customer__lifetime_value_band", "transaction__currency_code"]
    return metric_query(SEMANTIC_LAYER, s.metric_sources(), ["total_net_revenue"], keys)


OTHER_ATTRIBUTES = {
    "store__state_province_name": "s.state_province_name", "store__city": "s.city", "store__is_active": "s.is_active",
    "product__subcategory_name": "p.subcategory_name", "product__age_group": "p.age_group",
    "product__sport_occasion": "p.sport_occasion", "product__is_hero_product": "p.is_hero_product",
    "customer__country_code": "c.country_code", "customer__acquisition_channel": "c.acquisition_channel",
    "transaction__return_flag": "f.return_flag",
}


@query(
    "metric_dimension_alias_other",
    f"""SELECT {', '.join(f"{v} AS {k}" for k, v in OTHER_ATTRIBUTES.items())}, {ATOMS["total_quantity"]} AS total_quantity
FROM c_sales f LEFT JOIN c_stores s USING (store_sk) LEFT JOIN c_products p USING (product_sk) LEFT JOIN c_customers c USING (customer_sk)
GROUP BY ALL""",
)
def other_attributes(s: Star) -> DataFrame:
    """The attributes of the semantic layer that no other query groups by."""
    return metric_query(SEMANTIC_LAYER, s.metric_sources(), ["total_quantity"], list(OTHER_ATTRIBUTES))


def by_channel_daily(keys: str) -> str:
    return f"(SELECT {keys}, transaction_date, {money('net_revenue_usd')} AS rev {FROM_STAR} GROUP BY ALL)"


@query(
    "metric_cumulative",
    f"""SELECT metric_time__day, {D244.format("sum(rev) " + spine_over("INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))} AS trailing_7d_revenue,
  {D244.format("sum(rev) " + spine_over(SO_FAR))} AS cumulative_revenue,
  {D244.format("sum(rev) " + spine_over(SO_FAR, "PARTITION BY year(metric_time__day) "))} AS ytd_revenue FROM {SPINE}""",
)
def cumulative(s: Star) -> DataFrame:
    names = ["trailing_7d_revenue", "cumulative_revenue", "ytd_revenue"]
    return metric_query(SEMANTIC_LAYER, s.metric_sources(), names, ["metric_time__day"])


def on_all_days(key: str, daily: str) -> str:
    """Daily rows of each key, on every day between the first and the last of all keys."""
    return f"""(SELECT k.{key}, n.transaction_date, r.* EXCLUDE ({key}, transaction_date) FROM (SELECT DISTINCT {key} FROM {daily}) k
  CROSS JOIN (SELECT CAST(unnest(generate_series(CAST(min(transaction_date) AS TIMESTAMP), CAST(max(transaction_date) AS TIMESTAMP), INTERVAL 1 DAY))
    AS DATE) AS transaction_date FROM {daily}) n
  LEFT JOIN {daily} r ON r.{key} IS NOT DISTINCT FROM k.{key} AND r.transaction_date = n.transaction_date)"""


@query(
    "metric_stored_spine",
    f"""SELECT metric_time__day, {D244.format("sum(rev) " + spine_over("INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))} AS trailing_7d_revenue,
  {D244.format("sum(rev) " + spine_over(SO_FAR))} AS cumulative_revenue FROM {SPINE} QUALIFY isodow(metric_time__day) < 6""",
)
def stored_spine(s: Star) -> DataFrame:
    """A stored spine that has working days only: windows run over all days, results are shown for those of the spine."""
    working_days = stored(s.dates("full_date", "is_weekday").where("is_weekday").select(F.col("full_date").alias("date_day")), "time_spine")
    sources = replace(s.metric_sources(), spine=lambda: working_days)
    return metric_query(SEMANTIC_LAYER, sources, ["trailing_7d_revenue", "cumulative_revenue"], ["metric_time__day"])


@query(
    "metric_offset",
    f"""SELECT country_name AS country, transaction_date AS day, (CAST(rev AS DOUBLE) - CAST(prev AS DOUBLE))
  / nullif(CAST(prev AS DOUBLE), 0) * 100 AS growth
FROM (SELECT *, {D244.format("sum(rev) " + over("country_name", LAST_1))} AS prev FROM {on_all_days("country_name", by_channel_daily("country_name"))})""",
)
def offset(s: Star) -> DataFrame:
    return metric_query(
        SEMANTIC_LAYER, s.metric_sources(), {"growth": "day_over_day_revenue_growth"},
        {"country": "store__country_name", "day": "metric_time__day"},
    )


@query(
    "metric_cumulative_by_group",
    f"""SELECT region_name AS region, transaction_date AS day,
  {D244.format("sum(rev) " + over("region_name", "INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))} AS trailing_7d_revenue,
  {D244.format("sum(rev) " + over("region_name", SO_FAR))} AS cumulative_revenue
FROM {on_all_days("region_name", by_channel_daily("region_name"))}""",
)
def cumulative_by_group(s: Star) -> DataFrame:
    """Running values of every group go on to the last day of all."""
    return metric_query(
        SEMANTIC_LAYER, s.metric_sources(), ["trailing_7d_revenue", "cumulative_revenue"],
        {"region": "store__region_name", "day": "metric_time__day"},
    )


MARGIN_DAYS = f"(SELECT store_name, transaction_date, CAST({ATOMS['gross_margin']} AS DOUBLE) AS margin {FROM_STAR} GROUP BY ALL)"
WITH_MARGIN_BEFORE = replace(
    SEMANTIC_LAYER,
    metrics=SEMANTIC_LAYER.metrics | {"margin_before": Derived(
        "margin_before", "Gross margin a week before", inputs=(Input("gross_margin", days_ago=7),), formula=lambda c: c.cast("double")
    )},
)


@query(
    "metric_offset_derived",
    f"""SELECT store_name AS store, transaction_date AS day, max(margin) OVER (PARTITION BY store_name ORDER BY transaction_date
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS margin_before FROM {on_all_days("store_name", MARGIN_DAYS)}""",
)
def offset_of_derived(s: Star) -> DataFrame:
    """A metric composed of others, as it was a week earlier."""
    return metric_query(
        WITH_MARGIN_BEFORE, s.metric_sources(), ["margin_before"], {"store": "store__store_name", "day": "metric_time__day"}
    )


CHOSEN = "country_name = 'NATION_3' AND division_name IN ('ECONOMY', 'PROMO') AND transaction_date >= DATE '1997-01-01'"


@query(
    "metric_query",
    plain_sql(
        f"country_name AS store__country_name, division_name AS product__division_name, {MONTH}",
        {m: m for m in ("total_net_revenue", "gross_margin_pct", "return_rate")}, CHOSEN,
    ),
)
def general_query(s: Star) -> DataFrame:
    return metric_query(
        SEMANTIC_LAYER, s.metric_sources(), ["total_net_revenue", "gross_margin_pct", "return_rate"],
        ["store__country_name", "product__division_name", "metric_time__month"],
        where=[
            Condition("store__country_name", "=", "NATION_3"),
            Condition("product__division_name", "in", ["ECONOMY", "PROMO"]),
            Condition("metric_time__day", ">=", "1997-01-01"),
        ],
        order_by=["metric_time__month", "product__division_name"],
    )


@query(
    "metric_query_filter_before",
    f"""SELECT transaction_date, region_name, {D244.format("sum(rev) " + over("region_name", SO_FAR))} AS cumulative_revenue
FROM (SELECT * FROM {by_channel_daily("region_name")} WHERE transaction_date >= DATE '1998-01-01')""",
)
def filter_before(s: Star) -> DataFrame:
    """History before the bound is cut off, so the running total starts there."""
    return metric_query(
        METRIC_VIEW, s.metric_sources(), ["cumulative_revenue"], ["transaction_date", "region_name"],
        where=[Condition("transaction_date", ">=", "1998-01-01")], date_filter="before",
    )


@query(
    "metric_semiadditive_total",
    f"""SELECT region_name, arg_max(total, transaction_date) AS cumulative_revenue, arg_max(rev, transaction_date) AS current_day_revenue
FROM (SELECT *, {D244.format("sum(rev) " + over("region_name", SO_FAR))} AS total FROM {by_channel_daily("region_name")}) GROUP BY 1""",
)
def semiadditive(s: Star) -> DataFrame:
    """Windowed metrics without a date among the keys show their last day."""
    return metric_query(
        METRIC_VIEW, s.metric_sources(), ["cumulative_revenue", "current_day_revenue"], ["region_name"]
    )


@query("metric_export", plain_sql(f"region_name AS store__region_name, {MONTH}", {"total_net_revenue": "total_net_revenue"}))
def export(s: Star) -> DataFrame:
    path = scratch_folder(s.spark, "export")
    result = metric_query(
        SEMANTIC_LAYER, s.metric_sources(), ["total_net_revenue"], ["store__region_name", "metric_time__month"]
    )
    write_parquet(result, path)
    return read_parquet(s.spark, path, nullable(result.schema))


# --- predicate trees -------------------------------------------------------------------------

FROM_WIDE_STAR = FROM_STAR + " LEFT JOIN c_customers c USING (customer_sk)"
LOYAL = Condition("customer__loyalty_tier", "in", ["Gold", "Elite"])
KEPT = ~Condition("return_flag", "=", "Y")
WITH_CHOSEN_SALES = replace(
    SEMANTIC_LAYER,
    metrics=SEMANTIC_LAYER.metrics
    | {
        m.name: m
        for m in (
            Simple("loyal_revenue", "Loyal Revenue", measure=NET, where=LOYAL & KEPT),
            Simple("loyal_customers", "Loyal Customers", measure=CUSTOMERS, where=LOYAL),
            Simple("loyal_or_large", "Loyal or Large", measure=TRANSACTIONS, where=LOYAL | Condition("transaction__revenue_tier", "=", "High-Value")),
            Simple("unknown_buyers", "Unknown Buyers", measure=TRANSACTIONS, where=Condition("customer__customer_segment", "is null")),
        )
    },
)
IS_LOYAL = "loyalty_tier IN ('Gold', 'Elite')"


@query(
    "metric_filtered_by_entity",
    f"""SELECT region_name AS store__region_name, CAST(date_trunc('quarter', transaction_date) AS DATE) AS metric_time__quarter,
  {ATOMS["total_net_revenue"]} AS total_net_revenue,
  CAST(sum(net_revenue_usd) FILTER (WHERE {IS_LOYAL} AND return_flag <> 'Y') AS DECIMAL(24,4)) AS loyal_revenue,
  count(DISTINCT customer_sk) FILTER (WHERE {IS_LOYAL}) AS loyal_customers,
  count(DISTINCT transaction_id) FILTER (WHERE {IS_LOYAL} OR revenue_tier = 'High-Value') AS loyal_or_large,
  count(DISTINCT transaction_id) FILTER (WHERE customer_segment IS NULL) AS unknown_buyers {FROM_WIDE_STAR} GROUP BY ALL""",
)
def filtered_by_entity(s: Star) -> DataFrame:
    """Metrics over the rows that meet conditions on a joined table, next to one over all rows."""
    names = ["total_net_revenue", "loyal_revenue", "loyal_customers", "loyal_or_large", "unknown_buyers"]
    return metric_query(WITH_CHOSEN_SALES, s.metric_sources(), names, ["store__region_name", "metric_time__quarter"])


@query(
    "metric_query_or",
    plain_sql(
        f"gender_code AS customer__gender_code, {MONTH}", {m: m for m in ("total_net_revenue", "transaction_count", "unique_customers")},
        f"""({IS_LOYAL} OR revenue_tier = 'High-Value' AND quantity_sold IS NOT NULL)
  AND NOT (country_name LIKE 'NATION_1%' OR division_name IN ('ECONOMY', 'SMALL') AND return_flag = 'Y')
  AND (transaction_date BETWEEN DATE '1994-03-01' AND DATE '1997-06-30' OR transaction_date >= DATE '1998-05-01')""",
        FROM_WIDE_STAR,
    ),
)
def query_with_or(s: Star) -> DataFrame:
    """And, or and not over the fact, three tables and the date."""
    day, country, division = "metric_time__day", "store__country_name", "product__division_name"
    large = Condition("transaction__revenue_tier", "=", "High-Value")
    left_out = Condition(country, "like", "NATION_1%") | (Condition(division, "in", ["ECONOMY", "SMALL"]) & Condition("transaction__return_flag", "=", "Y"))
    dated = Condition(day, "between", (date(1994, 3, 1), date(1997, 6, 30))) | Condition(day, ">=", date(1998, 5, 1))
    return metric_query(
        SEMANTIC_LAYER, s.metric_sources(), ["total_net_revenue", "transaction_count", "unique_customers"],
        ["customer__gender_code", "metric_time__month"], where=(LOYAL | large) & ~left_out & dated,
    )


@query(
    "metric_query_semi_join",
    f"""SELECT metric_time__day, {D244.format("sum(rev) " + spine_over("INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))} AS trailing_7d_revenue,
  coalesce(n, 0) AS transaction_count
FROM (SELECT CAST(x AS DATE) AS metric_time__day, rev, n FROM (SELECT unnest(generate_series(CAST(min(transaction_date) AS TIMESTAMP),
    CAST(max(transaction_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS x FROM c_sales JOIN c_customers USING (customer_sk)
    WHERE {IS_LOYAL} AND customer_segment NOT LIKE 'A%')
  LEFT JOIN (SELECT transaction_date, {money('net_revenue_usd')} AS rev, count(DISTINCT transaction_id) AS n
    FROM c_sales JOIN c_customers USING (customer_sk) WHERE {IS_LOYAL} AND customer_segment NOT LIKE 'A%' GROUP BY 1)
  ON transaction_date = CAST(x AS DATE))""",
)
def query_semi_joined(s: Star) -> DataFrame:
    """Conditions on a table that is not shown: facts look for a key among the chosen ones."""
    return metric_query(
        SEMANTIC_LAYER, s.metric_sources(), ["trailing_7d_revenue", "transaction_count"], ["metric_time__day"],
        where=[LOYAL, ~Condition("customer__customer_segment", "like", "A%")],
    ).fillna(0, ["transaction_count"])


# --- catalog, synonyms, formats --------------------------------------------------------------


@query(
    "metric_synonym_lookup",
    f"""SELECT region_name AS "business region", {ATOMS["total_net_revenue"]} AS "net sales", {ATOMS["avg_order_value"]} AS aov,
  {ATOMS["transaction_count"]} AS "order count" {FROM_STAR} GROUP BY 1""",
)
def synonyms(s: Star) -> DataFrame:
    """A query in business words; each word is looked up among labels and synonyms."""
    return metric_query(
        METRIC_VIEW, s.metric_sources(), ["net sales", "aov", "order count"], {"business region": "geography"}
    )


@query(
    "metric_synonym_lookup_terms",
    """SELECT o_orderkey, term, CASE term WHEN 'Revenue' THEN 'total_net_revenue' WHEN 'aov ' THEN 'avg_order_value'
  WHEN 'business unit' THEN 'division_name' END AS name FROM (SELECT o_orderkey,
  (['Revenue', 'aov ', 'business unit', 'unknown word'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS term FROM orders)""",
)
def term_lookup(s: Star) -> DataFrame:
    words = F.array(*[F.lit(w) for w in ("Revenue", "aov ", "business unit", "unknown word")])
    asked = s.raw("orders").select("o_orderkey", F.element_at(words, (F.pmod("o_orderkey", F.lit(4)) + 1).cast("int")).alias("term"))
    return lookup_terms(asked, metric_catalog(s.spark, METRIC_VIEW)).select("o_orderkey", "term", "name")


LAYERS = ((METRIC_VIEW, "transaction_year"), (SEMANTIC_LAYER, "metric_time__year"))


def all_by_year(s: Star, layer: Layer, year: str) -> DataFrame:
    """One row per year with every metric of the layer, in double precision."""
    wide = metric_query(layer, s.metric_sources(), list(layer.metrics), {"year": year})
    return wide.select("year", *[F.col(m).cast("double").alias(m) for m in layer.metrics])


def windowed_values(layer: str, days: str, day: str, window: tuple[int, int], growth: str, more: dict[str, str]) -> str:
    """Windowed metrics at the last day of each year; `window` is the seven days' frame, `growth` the year's daily growth."""
    first, last = window
    frame = f"INTERVAL {first} DAY PRECEDING AND " + ("CURRENT ROW" if last == 0 else f"INTERVAL {last} DAY PRECEDING")

    def total(frame: str, by: str = "") -> str:
        return f"CAST(sum(rev) OVER ({by}ORDER BY {day} RANGE BETWEEN {frame}) AS DOUBLE)"

    columns = {
        "trailing_7d_revenue": total(frame), "cumulative_revenue": total(SO_FAR), "ytd_revenue": total(SO_FAR, f"PARTITION BY year({day}) "),
    } | more
    ends = f"""(SELECT {day} AS day, CAST(date_trunc('year', {day}) AS DATE) AS year, {', '.join(f"{v} AS {k}" for k, v in columns.items())}
  FROM {days} QUALIFY row_number() OVER (PARTITION BY year({day}) ORDER BY {day} DESC) = 1)"""
    parts = [f"SELECT '{layer}' AS layer, year, '{k}' AS name, {k} AS value FROM {ends}" for k in columns]
    parts.append(f"""SELECT '{layer}', year, 'trailing_7d_customers', CAST(count(DISTINCT customer_sk) AS DOUBLE) FROM {ends} LEFT JOIN c_sales
  ON transaction_date BETWEEN day - INTERVAL {first} DAY AND day - INTERVAL {last} DAY GROUP BY year""")
    return " UNION ALL ".join([*parts, growth.format(ends=ends)])


ALL_VALUES = " UNION ALL ".join(
    [
        f"SELECT '{layer.name}' AS layer, transaction_year AS year, '{m}' AS name, CAST({sql} AS DOUBLE) AS value FROM c_sales GROUP BY 2"
        for layer, _ in LAYERS for m, sql in ATOMS.items()
    ]
    + [
        windowed_values(
            "metric_view", f"({daily_sql('')})", "transaction_date", (7, 1),
            """SELECT 'metric_view', year, 'day_over_day_growth',
  (current_day_revenue - previous_day_revenue) / nullif(previous_day_revenue, 0) * 100 FROM {ends}""",
            {"current_day_revenue": "CAST(rev AS DOUBLE)", "previous_day_revenue": f"CAST(sum(rev) {over('', LAST_1)} AS DOUBLE)"},
        ),
        windowed_values(
            "semantic_layer", SPINE, "metric_time__day", (6, 0),
            f"""SELECT 'semantic_layer', CAST(date_trunc('year', metric_time__day) AS DATE), 'day_over_day_revenue_growth',
  (CAST(sum(rev) AS DOUBLE) - CAST(sum(prev) AS DOUBLE)) / nullif(CAST(sum(prev) AS DOUBLE), 0) * 100
  FROM (SELECT metric_time__day, rev, sum(rev) {spine_over(LAST_1)} AS prev FROM {SPINE}) GROUP BY 2""",
            {},
        ),
    ]
)


@query(
    "metric_catalog",
    f"""SELECT c.layer, year, c.name, kind, label, declared_format, synonyms, value
FROM (VALUES {entry_rows()}) c(layer, name, kind, label, declared_format, synonyms)
LEFT JOIN ({ALL_VALUES}) t ON t.layer = c.layer AND t.name = c.name""",
)
def catalog(s: Star) -> DataFrame:
    """Every metric and dimension of both layers, metrics with their value per year."""

    def of(layer: Layer, year: str) -> DataFrame:
        entries = metric_catalog(s.spark, layer).select("layer", "name", "kind", "label", "declared_format", F.array_join("synonyms", ", ").alias("synonyms"))
        values = all_by_year(s, layer, year).unpivot(["year"], list(layer.metrics), "name", "value")
        return entries.join(values, "name", "left").select("layer", "year", "name", "kind", "label", "declared_format", "synonyms", "value")

    return reduce(DataFrame.unionByName, [of(*layer) for layer in LAYERS])


@query("metric_format", f"SELECT layer, year, name, {shown_sql()} AS shown FROM ({ALL_VALUES}) WHERE (layer, name) IN ({formatted()})")
def formats(s: Star) -> DataFrame:
    """Every metric that declares a format, as text per year; the semantic layer declares none."""
    declared = [m.name for m in METRIC_VIEW.metrics.values() if m.format]
    values = metric_query(METRIC_VIEW, s.metric_sources(), declared, {"year": "transaction_year"})
    shown = [format_value(F.col(m).cast("double"), METRIC_VIEW.metrics[m].format).alias(m) for m in declared]
    texts = values.select("year", *shown).unpivot(["year"], declared, "name", "shown")
    return texts.select(F.lit(METRIC_VIEW.name).alias("layer"), "year", "name", "shown")
