"""The five KPI reports, nine metric-view queries and thirteen semantic-layer queries."""

from __future__ import annotations

from datetime import date

from shelfline.plans import reports
from shelfline.plans.metric_queries import metric_view_queries, semantic_layer_queries
from workload.oracle import half_up, money, ratio, units
from workload.registry import add

SINCE, SINCE_LATER = date(1998, 1, 1), date(1998, 6, 1)
COUNTRY = "NATION_3"

SALES = (
    "transaction_id", "transaction_date_sk", "return_flag", "quantity_sold",
    "gross_revenue", "discount_amount", "cost_of_goods_sold", "gross_margin", "net_revenue_usd",
)
STAR_JOIN = """FROM c_sales f JOIN c_dates d ON d.date_sk = f.transaction_date_sk
JOIN c_products p ON p.product_sk = f.product_sk JOIN c_stores s ON s.store_sk = f.store_sk"""
ROLLUP_KEYS = "year_num, quarter_name, month_name, division_name, category_name, region_name, country_name"

add(
    "q_rollup_revenue",
    lambda s: reports.revenue_rollup(
        s.star_sales(
            "transaction_date_sk", "return_flag", "quantity_sold", "net_revenue_usd", "gross_revenue",
            "discount_amount", "cost_of_goods_sold", "gross_margin",
            product=("division_name", "category_name"), store=("region_name", "country_name"),
        ),
        s.dates("date_sk", "year_num", "quarter_name", "month_name"),
    ),
    f"""SELECT {ROLLUP_KEYS}, {money("net_revenue_usd")} AS total_net_revenue, {units("quantity_sold")} AS total_units_sold,
  {money("gross_revenue")} AS total_gross_revenue, {money("discount_amount")} AS total_discount,
  {money("cost_of_goods_sold")} AS total_cogs, {money("gross_margin")} AS total_gross_margin
{STAR_JOIN} WHERE return_flag = 'N' GROUP BY ROLLUP ({ROLLUP_KEYS})""",
)

INVENTORY_SQL = f"""SELECT month_year, category_name, subcategory_name, region_name, {units("on_hand_qty")} AS period_end_on_hand,
  {units("available_to_sell_qty")} AS period_end_ats, {money("inventory_cost_value")} AS period_end_cost_value,
  {money("inventory_retail_value")} AS period_end_retail_value,
  CAST(sum(on_hand_qty) AS DOUBLE) / count(on_hand_qty) AS avg_daily_on_hand
FROM c_inventory i JOIN c_dates d ON d.date_sk = i.snapshot_date_sk JOIN c_items USING (product_sk)
JOIN c_sites USING (store_sk) WHERE full_date = last_day(full_date) GROUP BY 1, 2, 3, 4"""


def inventory_report(s):
    return reports.period_end_inventory(s.inventory(), s.dates("date_sk", "full_date", "month_year"), s.items(), s.sites())


add("q_period_end_inventory", inventory_report, INVENTORY_SQL)


def rounded(a: str, b: str, factor: str = "") -> str:
    return half_up(ratio(a, b) + factor, 2)


RATIOS_SQL = f"""SELECT *, {rounded("gross_margin", "net_revenue", " * 100")} AS gross_margin_pct,
  {rounded("total_discount", "gross_revenue", " * 100")} AS discount_rate_pct,
  {rounded("net_revenue", "num_transactions")} AS avg_transaction_value,
  {rounded("net_revenue", "units_sold")} AS avg_selling_price,
  {rounded("units_sold", "num_transactions")} AS avg_units_per_transaction
FROM (SELECT year_num, quarter_name, category_name, region_name, {money("net_revenue_usd")} AS net_revenue,
  {money("gross_revenue")} AS gross_revenue, {money("gross_margin")} AS gross_margin,
  {money("cost_of_goods_sold")} AS cogs, {money("discount_amount")} AS total_discount,
  count(DISTINCT transaction_id) AS num_transactions, {units("quantity_sold")} AS units_sold
{STAR_JOIN} WHERE return_flag = 'N' GROUP BY 1, 2, 3, 4)"""


def ratio_report(s):
    return reports.non_additive_ratios(
        s.star_sales(*SALES, product=("category_name",), store=("region_name",)),
        s.dates("date_sk", "year_num", "quarter_name"),
    )


add("q_non_additive_ratios", ratio_report, RATIOS_SQL)

LEVELS = (
    "year_num", "quarter_name", "month_name", "full_date",
    "division_name", "category_name", "subcategory_name", "product_line_name",
)
FLAGS = ", ".join(f"CAST(grouping({c}) AS INTEGER) AS {f}" for c, f in reports.LEVEL_FLAGS.items())
DRILL_SQL = f"""SELECT {FLAGS}, {', '.join(LEVELS)}, {money("net_revenue_usd")} AS net_revenue, {units("quantity_sold")} AS units_sold,
  {money("gross_margin")} AS gross_margin, {rounded("sum(gross_margin)", "sum(net_revenue_usd)", " * 100")} AS gm_pct
FROM c_sales f JOIN c_dates d ON d.date_sk = f.transaction_date_sk JOIN c_products p ON p.product_sk = f.product_sk
WHERE return_flag = 'N' GROUP BY GROUPING SETS (
  (year_num), (year_num, quarter_name), (year_num, quarter_name, month_name),
  (year_num, quarter_name, month_name, full_date), (division_name), (division_name, category_name),
  (division_name, category_name, subcategory_name),
  (division_name, category_name, subcategory_name, product_line_name), (year_num, division_name, category_name))"""


def drill_report(s):
    sales = s.star_sales(
        "transaction_date_sk", "return_flag", "quantity_sold", "gross_margin", "net_revenue_usd",
        product=reports.PRODUCT_LEVELS,
    )
    return reports.hierarchy_drill(sales, s.dates("date_sk", *reports.DATE_LEVELS))


add("q_hierarchy_grouping_sets", drill_report, DRILL_SQL)

SOLD_AND_RETURNED = f"""(SELECT s.product_sk, s.transaction_date_sk, s.gross_net_revenue, s.units_sold,
    coalesce(total_refunds, 0) AS total_refunds, coalesce(units_returned, 0) AS units_returned
  FROM (SELECT product_sk, transaction_date_sk, {money("net_revenue_usd")} AS gross_net_revenue,
      {units("quantity_sold")} AS units_sold FROM c_sales WHERE return_flag = 'N' GROUP BY 1, 2) s
  LEFT JOIN (SELECT product_sk, return_date_sk, {money("refund_amount")} AS total_refunds,
      {units("quantity_returned")} AS units_returned FROM c_returns GROUP BY 1, 2) r
    ON r.product_sk = s.product_sk AND r.return_date_sk = s.transaction_date_sk)"""
NET_SQL = f"""SELECT category_name, year_num, quarter_name, {money("gross_net_revenue")} AS gross_net_revenue,
  {money("total_refunds")} AS total_refunds,
  CAST(sum(gross_net_revenue) - sum(total_refunds) AS DECIMAL(24,4)) AS net_revenue_after_returns,
  {units("units_sold")} AS units_sold, {units("units_returned")} AS units_returned,
  {rounded("sum(units_returned)", "sum(units_sold)", " * 100")} AS return_rate_pct
FROM {SOLD_AND_RETURNED} s JOIN c_products p USING (product_sk) JOIN c_dates d ON d.date_sk = s.transaction_date_sk
GROUP BY 1, 2, 3"""
SOLD = ("product_sk", "transaction_date_sk", "return_flag", "net_revenue_usd", "quantity_sold")
RETURNED = ("product_sk", "return_date_sk", "refund_amount", "quantity_returned")


def net_report(s):
    return reports.net_after_returns(
        s.sales(*SOLD), s.returns(*RETURNED), s.dates("date_sk", "year_num", "quarter_name"),
        s.products("product_sk", "category_name"),
    )


add("q_net_after_returns", net_report, NET_SQL)

# --- metric view --------------------------------------------------------------------

ATOMS = {
    "total_net_revenue": money("net_revenue_usd"),
    "total_gross_revenue": money("gross_revenue"),
    "total_cogs": money("cost_of_goods_sold"),
    "total_discount": money("discount_amount"),
    "total_quantity": units("quantity_sold"),
    "transaction_count": "count(DISTINCT transaction_id)",
    "unique_customers": "count(DISTINCT customer_sk)",
    "return_transactions": "count(DISTINCT transaction_id) FILTER (WHERE return_flag = 'Y')",
    "gross_margin": "CAST(sum(net_revenue_usd) - sum(cost_of_goods_sold) AS DECIMAL(24,4))",
    "gross_margin_pct": ratio("sum(net_revenue_usd) - sum(cost_of_goods_sold)", "sum(net_revenue_usd)") + " * 100",
    "avg_order_value": ratio("sum(net_revenue_usd)", "count(DISTINCT transaction_id)"),
    "avg_selling_price": ratio("sum(net_revenue_usd)", "sum(quantity_sold)"),
    "discount_rate": ratio("sum(discount_amount)", "sum(gross_revenue)"),
    "return_rate": ratio(
        "count(DISTINCT transaction_id) FILTER (WHERE return_flag = 'Y')", "count(DISTINCT transaction_id)"
    ),
}
FROM_STAR = "FROM c_sales f LEFT JOIN c_stores s USING (store_sk) LEFT JOIN c_products p USING (product_sk)"


def plain_sql(keys: str, metrics: dict[str, str], where: str = "TRUE", source: str = FROM_STAR) -> str:
    chosen = ", ".join(f"{ATOMS[m]} AS {o}" for o, m in metrics.items())
    return f"SELECT {keys}, {chosen} {source} WHERE {where} GROUP BY ALL"


def daily_sql(keys: str, extra: str = "") -> str:
    """Sums per key and day, the input of every window."""
    comma = f"{keys}, " if keys else ""
    return f"SELECT {comma}transaction_date, {money('net_revenue_usd')} AS rev{extra} {FROM_STAR} GROUP BY ALL"


def over(keys: str, frame: str) -> str:
    by = f"PARTITION BY {keys} " if keys else ""
    return f"OVER ({by}ORDER BY transaction_date RANGE BETWEEN {frame})"


LAST_7 = "INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"
LAST_1 = "INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"
SO_FAR = "UNBOUNDED PRECEDING AND CURRENT ROW"
D244 = "CAST({} AS DECIMAL(24,4))"


def trailing_customers(keys: str) -> str:
    """Distinct customers of the seven days before each key's day, by a range self-join."""
    names = keys.split(", ")
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in names)
    listed = ", ".join(f"a.{k}" for k in names)
    return f"""(SELECT {listed}, a.transaction_date, count(DISTINCT b.customer_sk) AS n
  FROM (SELECT DISTINCT {keys}, transaction_date {FROM_STAR}) a
  LEFT JOIN (SELECT DISTINCT {keys}, transaction_date, customer_sk {FROM_STAR}) b
    ON {same} AND b.transaction_date BETWEEN a.transaction_date - INTERVAL 7 DAY AND a.transaction_date - INTERVAL 1 DAY
  GROUP BY ALL)"""


ORACLES = {
    "q_mv_atomic": plain_sql(
        "region_name, category_name",
        {"net_revenue": "total_net_revenue", "gross_revenue": "total_gross_revenue", "units_sold": "total_quantity",
         "txn_count": "transaction_count", "customers": "unique_customers"},
        "transaction_date >= DATE '1998-01-01'",
    ),
    "q_mv_composed": plain_sql(
        "division_name, category_name",
        {"net_revenue": "total_net_revenue", "cogs": "total_cogs", "gross_margin": "gross_margin",
         "margin_pct": "gross_margin_pct", "aov": "avg_order_value", "asp": "avg_selling_price",
         "discount_rate": "discount_rate", "return_rate": "return_rate"},
        "transaction_date >= DATE '1998-01-01'",
    ),
    "q_mv_join_slice": plain_sql(
        "region_name, country_name, store_format, division_name, gender_target",
        {"net_revenue": "total_net_revenue", "margin_pct": "gross_margin_pct", "aov": "avg_order_value"},
        "transaction_date >= DATE '1998-01-01'",
    ),
    "q_mv_revenue_tier": plain_sql(
        "revenue_tier",
        {"txn_count": "transaction_count", "net_revenue": "total_net_revenue", "asp": "avg_selling_price",
         "return_rate": "return_rate"},
        "transaction_date >= DATE '1998-01-01'", "FROM c_sales",
    ),
    "q_mv_trailing_by_store": f"""SELECT d.transaction_date, d.store_name, t7d_revenue, n AS t7d_customers
FROM (SELECT *, {D244.format("sum(rev) " + over("store_name", LAST_7))} AS t7d_revenue FROM ({daily_sql("store_name")})) d
JOIN {trailing_customers("store_name")} c ON c.store_name = d.store_name AND c.transaction_date = d.transaction_date
WHERE d.transaction_date >= DATE '1998-06-01'""",
    "q_mv_day_over_day": f"""SELECT transaction_date, region_name, rev AS today_revenue, prev AS yesterday_revenue,
  (CAST(rev AS DOUBLE) - CAST(prev AS DOUBLE)) / nullif(CAST(prev AS DOUBLE), 0) * 100 AS dod_growth_pct
FROM (SELECT *, {D244.format("sum(rev) " + over("region_name", LAST_1))} AS prev FROM ({daily_sql("region_name")}))
WHERE transaction_date >= DATE '1998-06-01'""",
    "q_mv_cumulative": f"""SELECT * FROM (SELECT transaction_date, rev AS daily_revenue,
  {D244.format("sum(rev) " + over("", SO_FAR))} AS running_total FROM ({daily_sql("")}))
WHERE transaction_date >= DATE '1998-01-01'""",
    "q_mv_ytd": f"""SELECT * FROM (SELECT transaction_date, CAST(date_trunc('month', transaction_date) AS DATE) AS month,
  {D244.format("sum(rev) " + over("year(transaction_date)", SO_FAR))} AS ytd_revenue FROM ({daily_sql("")}))
WHERE transaction_date >= DATE '1998-01-01'""",
    "q_mv_kpi_board": f"""SELECT d.transaction_date, d.region_name, d.category_name, rev AS daily_revenue, t7d_revenue, running_total,
  ytd_revenue, (CAST(rev AS DOUBLE) - CAST(prev AS DOUBLE)) / nullif(CAST(prev AS DOUBLE), 0) * 100 AS dod_growth_pct,
  margin_pct, aov, discount_rate, n AS t7d_customers
FROM (SELECT *, {D244.format("sum(rev) " + over("region_name, category_name", LAST_7))} AS t7d_revenue,
    {D244.format("sum(rev) " + over("region_name, category_name", LAST_1))} AS prev,
    {D244.format("sum(rev) " + over("region_name, category_name", SO_FAR))} AS running_total,
    {D244.format("sum(rev) " + over("region_name, category_name, year(transaction_date)", SO_FAR))} AS ytd_revenue
  FROM ({daily_sql("region_name, category_name", f", {ATOMS['gross_margin_pct']} AS margin_pct, {ATOMS['avg_order_value']} AS aov, {ATOMS['discount_rate']} AS discount_rate")})) d
JOIN {trailing_customers("region_name, category_name")} c ON c.region_name = d.region_name
  AND c.category_name = d.category_name AND c.transaction_date = d.transaction_date
WHERE d.transaction_date >= DATE '1998-06-01'""",
}

# --- semantic layer -------------------------------------------------------------------

MONTH = "CAST(date_trunc('month', transaction_date) AS DATE) AS metric_time__month"
SPINE = f"""(SELECT CAST(x AS DATE) AS metric_time__day, rev FROM (SELECT unnest(generate_series(
    CAST(min(transaction_date) AS TIMESTAMP), CAST(max(transaction_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS x FROM c_lines)
  LEFT JOIN ({daily_sql("")}) ON transaction_date = CAST(x AS DATE))"""


def spine_over(frame: str, by: str = "") -> str:
    return f"OVER ({by}ORDER BY metric_time__day RANGE BETWEEN {frame})"


def same(names: str) -> dict[str, str]:
    return {n: n for n in names.split(",")}


ORACLES |= {
    "q_sl_revenue_by_month": plain_sql(MONTH, same("total_net_revenue")),
    "q_sl_revenue_by_region": plain_sql("region_name AS store__region_name", same("total_net_revenue")),
    "q_sl_counts_by_category": plain_sql(
        "category_name AS product__category_name", same("transaction_count,unique_customers")
    ),
    "q_sl_returns_by_month": plain_sql(MONTH, same("return_transactions")),
    "q_sl_margin_by_region": plain_sql("region_name AS store__region_name", same("gross_margin,gross_margin_pct")),
    "q_sl_aov_by_format": plain_sql("store_format AS store__store_format", same("avg_order_value")),
    "q_sl_discount_by_division": plain_sql("division_name AS product__division_name", same("discount_rate")),
    "q_sl_return_rate_by_month": plain_sql(MONTH, same("return_rate")),
    "q_sl_trailing_by_day": f"""SELECT metric_time__day,
  {D244.format("sum(rev) " + spine_over("INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))} AS trailing_7d_revenue FROM {SPINE}""",
    "q_sl_ytd_by_month": f"""SELECT CAST(date_trunc('month', metric_time__day) AS DATE) AS metric_time__month,
  arg_max(v, metric_time__day) AS ytd_revenue FROM (SELECT metric_time__day,
  {D244.format("sum(rev) " + spine_over(SO_FAR, "PARTITION BY year(metric_time__day) "))} AS v FROM {SPINE}) GROUP BY 1""",
    "q_sl_cumulative_by_day": f"""SELECT metric_time__day, {D244.format("sum(rev) " + spine_over(SO_FAR))} AS cumulative_revenue
FROM {SPINE}""",
    "q_sl_dod_by_day": f"""SELECT metric_time__day, (CAST(rev AS DOUBLE) - CAST(prev AS DOUBLE)) / nullif(CAST(prev AS DOUBLE), 0) * 100
  AS day_over_day_revenue_growth FROM (SELECT metric_time__day, rev,
    {D244.format("sum(rev) " + spine_over(LAST_1))} AS prev FROM {SPINE})""",
    "q_sl_country_quarter": plain_sql(
        "country_name AS store__country_name, CAST(date_trunc('quarter', transaction_date) AS DATE) AS metric_time__quarter",
        same("total_net_revenue,gross_margin_pct"), f"country_name = '{COUNTRY}'",
    ),
}

for _name, _saved in {**metric_view_queries(SINCE, SINCE_LATER), **semantic_layer_queries(COUNTRY)}.items():
    add(_name, lambda s, saved=_saved: saved.run(s.metric_sources()), ORACLES[_name])
