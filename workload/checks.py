"""Data quality checks and KPI summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.quality import checks, kpis
from shelfline.rules import stores
from shelfline.schemas import TABLES
from shelfline.sources.readers import table_summary
from workload.business import GEOGRAPHY_SQL
from workload.oracle import money, ratio, units
from workload.registry import add, query
from workload.star import Star

FACTS = {
    "fact_sales_transactions": ("c_sales", "transaction_date_sk product_sk store_sk channel_sk customer_sk employee_sk promotion_sk"),
    "fact_inventory_snapshot": ("c_inventory", "snapshot_date_sk product_sk store_sk"),
    "fact_returns": ("c_returns", "return_date_sk product_sk store_sk channel_sk customer_sk"),
    "fact_web_sessions": ("c_sessions", "session_date_sk channel_sk customer_sk"),
}
DIMS = {
    "dim_date": "c_dates", "dim_product": "c_products", "dim_store": "c_stores", "dim_customer": "c_customers",
    "dim_employee": "(SELECT * FROM c_employees WHERE is_active)", "dim_promotion": "c_promotions",
    "dim_channel": "(SELECT unnest(range(1, 11)) AS channel_sk)",
}


def star_tables(s: Star) -> dict[str, DataFrame]:
    """All tables but geography. Only active staff counts as known, so that some keys are orphans."""
    return {
        "fact_sales_transactions": s.sales(*FACTS["fact_sales_transactions"][1].split()),
        "fact_inventory_snapshot": s.inventory(),
        "fact_returns": s.returns(),
        "fact_web_sessions": s.sessions(),
        "dim_date": s.dates("date_sk"),
        "dim_product": s.products("product_sk"),
        "dim_store": s.stores("store_sk"),
        "dim_customer": s.customers("customer_sk"),
        "dim_employee": s.employees().where("is_active"),
        "dim_promotion": s.promotions(),
        "dim_channel": stores.build_dim_channel(s.spark),
    }


def fk_sql() -> str:
    parts = []
    for k in checks.FOREIGN_KEYS:
        fact, dim = FACTS[k.fact][0], DIMS[k.dim]
        orphan = f"""count(DISTINCT f.{k.fact_key}) FILTER (WHERE f.{k.fact_key} IS NOT NULL AND d.k IS NULL)"""
        parts.append(
            f"""SELECT '{k.fact}' AS fact_table, '{k.fact_key}' AS fk_column, '{k.dim}' AS dim_table, '{k.dim_key}' AS pk_column,
  {orphan} AS orphan_keys, {orphan} = 0 AS is_valid FROM {fact} f LEFT JOIN (SELECT DISTINCT {k.dim_key} AS k FROM {dim}) d ON d.k = f.{k.fact_key}"""
        )
    return " UNION ALL ".join(parts)


add("dq_foreign_keys", lambda s: checks.check_foreign_keys(star_tables(s)), fk_sql())


def pk_sql(table: str, source: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) FILTER (WHERE n > 1 AND k IS NOT NULL) AS duplicate_keys,
  CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1 AND k IS NOT NULL), 0) AS BIGINT) AS surplus_rows,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_rows
FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY 1)"""


def allowed_sql(table: str, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM {source}
WHERE {c} NOT IN ({', '.join(f"'{v}'" for v in values)}) GROUP BY {c}"""
        for c, values in TABLES[table].allowed.items()
    )


add(
    "dq_conversion_consistency",
    lambda s: checks.check_conversions(
        s.funnels().join(s.sessions().select("session_sk", "purchase_transaction_sk"), "session_sk")
    ).select("session_sk", "session_date_sk"),
    """SELECT f.session_sk, f.session_date_sk FROM c_funnels f JOIN c_sessions s USING (session_sk)
WHERE f.purchase_completed_flag <> (s.purchase_transaction_sk IS NOT NULL)""",
)

REVENUE = ("gross_revenue", "discount_amount", "net_revenue", "cost_of_goods_sold", "gross_margin")
add(
    "kpi_revenue",
    lambda s: kpis.kpi_revenue(s.sales(*REVENUE)),
    f"""SELECT {money("gross_revenue")} AS total_gross_revenue, {money("discount_amount")} AS total_discounts,
  {money("net_revenue")} AS total_net_revenue, {money("cost_of_goods_sold")} AS total_cogs,
  {money("gross_margin")} AS total_gross_margin FROM c_sales""",
)
add(
    "kpi_profitability",
    lambda s: kpis.kpi_profitability(s.sales("transaction_id", *REVENUE)),
    f"""SELECT {ratio("sum(gross_margin)", "sum(net_revenue)")} * 100 AS gross_margin_pct,
  {ratio("sum(discount_amount)", "sum(gross_revenue)")} * 100 AS discount_rate_pct,
  {ratio("sum(net_revenue)", "count(DISTINCT transaction_id)")} AS avg_order_value,
  count(DISTINCT transaction_id) AS transaction_count FROM c_sales""",
)
add(
    "kpi_returns",
    lambda s: kpis.kpi_returns(s.sales("transaction_id"), s.returns("refund_amount")),
    f"""SELECT count(*) AS return_lines, {money("refund_amount")} AS total_refunds,
  {ratio("count(*)", "(SELECT count(*) FROM c_lines)")} * 100 AS return_rate_pct FROM c_returns""",
)
add(
    "kpi_digital",
    lambda s: kpis.kpi_digital(s.sessions()),
    f"""SELECT count(*) AS sessions, {ratio("count(*) FILTER (WHERE bounce_flag)", "count(*)")} * 100 AS bounce_rate_pct,
  {ratio("count(*) FILTER (WHERE purchase_completed_flag)", "count(*)")} * 100 AS conversion_rate_pct FROM c_sessions""",
)
add(
    "kpi_inventory",
    lambda s: kpis.kpi_inventory(s.stored_inventory()),
    f"""SELECT {units("on_hand_qty")} AS total_on_hand, count(*) FILTER (WHERE stockout_flag = 'Y') AS stockout_count,
  {ratio("count(*) FILTER (WHERE stockout_flag = 'Y')", "count(*)")} * 100 AS stockout_rate_pct
FROM c_inventory WHERE snapshot_date_sk = (SELECT max(snapshot_date_sk) FROM c_inventory)""",
)
SUMMED = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6}
add(
    "table_summary",
    lambda s: table_summary({t: s.raw(t) for t in SUMMED}),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS cnt, {n} AS column_count FROM {t}" for t, n in SUMMED.items()
    ),
)


# --- the checks over all twelve tables -----------------------------------------------------------

CHANNEL_ROWS = ", ".join(
    f"({sk}, 'CHN-{sk:02d}', '{stores.channel_name(sk)}', '{cat}', '{kind}', {dig}, {own})" for sk, cat, kind, dig, own in stores.CHANNELS
)
SOURCES = {t: view for t, (view, _) in FACTS.items()} | DIMS | {
    "dim_employee": "c_employees",
    "dim_promotion": "(SELECT *, 'P' || promotion_sk AS promotion_nk, 'P' || promotion_sk AS promotion_name, FALSE AS stackable_flag FROM c_promotions)",
    "dim_channel": f"""(SELECT * FROM (VALUES {CHANNEL_ROWS})
  c(channel_sk, channel_nk, channel_name, channel_category, channel_type, is_digital, is_owned))""",
    "dim_geography": f"({GEOGRAPHY_SQL})",
}
#: Required columns that no rule builds: the declared default fills them when a table is written.
DEFAULTED = {
    "load_timestamp", "created_timestamp", "updated_timestamp", "units_shrinkage_today", "units_returned_today", "return_shipping_cost",
}
REQUIRED = {t: [c for c in spec.required if c not in DEFAULTED] for t, spec in TABLES.items()}


def whole_tables(s: Star) -> dict[str, DataFrame]:
    """All twelve tables with all columns, and all staff."""
    return star_tables(s) | {
        "fact_sales_transactions": s.promoted_sales(), "dim_date": s.dates(), "dim_product": s.products(), "dim_store": s.stores(),
        "dim_customer": s.customers(), "dim_employee": s.employees(), "dim_geography": stores.build_dim_geography(s.raw_stores()),
    }


add(
    "dq_not_null",
    lambda s: checks.check_not_nulls(whole_tables(s), REQUIRED),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {SOURCES[t]}"
        for t, columns in REQUIRED.items() for c in columns
    ),
)
ALLOWED = {t: spec.allowed for t, spec in TABLES.items() if spec.allowed}
add(
    "dq_allowed_values",
    lambda s: checks.check_all_allowed(whole_tables(s), ALLOWED),
    " UNION ALL ".join(allowed_sql(t, SOURCES[t]) for t in ALLOWED),
)
#: Columns that are no keys, to show what the check finds.
NO_KEYS = {"ticket_numbers": "transaction_id", "known_customers": "customer_sk"}


@query(
    "dq_primary_key",
    " UNION ALL ".join(
        [pk_sql(t, SOURCES[t], spec.primary_key) for t, spec in TABLES.items()] + [pk_sql(name, "c_lines", c) for name, c in NO_KEYS.items()]
    ),
)
def primary_keys(s: Star) -> DataFrame:
    """The keys of all twelve tables, and two columns that are not keys."""
    whole = whole_tables(s)
    sales = whole["fact_sales_transactions"]
    return checks.check_primary_keys(
        {t: (df, TABLES[t].primary_key) for t, df in whole.items()} | {name: (sales, c) for name, c in NO_KEYS.items()}
    )
