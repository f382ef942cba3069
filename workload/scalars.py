"""Scalar functions over dates, parts, customers and sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import params
from shelfline.functions import dates, ratios, text
from shelfline.rules.pricing import exchange_rate
from workload.oracle import REASON_TEXTS, REASONS, calendar_sql, date_sk, half_up, pad, pick, title
from workload.registry import add, query
from workload.star import Star

DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


def order_days(s: Star) -> DataFrame:
    return s.raw("orders").select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()


def calendar_attributes(name: str, *columns: str) -> None:
    """Attributes of every date on which something was ordered."""

    def run(s: Star) -> DataFrame:
        known = dates.calendar_columns(F.col("full_date"), columns)
        return order_days(s).select("full_date", *[known[c].alias(c) for c in columns])

    add(name, run, f"SELECT full_date, {', '.join(columns)} FROM ({calendar_sql(DAYS)})")


def of_days(name: str, columns: dict[str, tuple[Column, str]]) -> None:
    add(
        name,
        lambda s: order_days(s).select("full_date", *[c().alias(n) for n, (c, _) in columns.items()]),
        f"SELECT d AS full_date, {', '.join(f'{q} AS {n}' for n, (_, q) in columns.items())} FROM {DAYS}",
    )


def day() -> Column:
    return F.col("full_date")


add(
    "fn_date_from_sk",
    lambda s: order_days(s).select(dates.date_to_sk(day()).alias("date_sk")).withColumn(
        "full_date", dates.date_from_sk(F.col("date_sk"))
    ),
    f"SELECT d AS full_date, {date_sk('d')} AS date_sk FROM {DAYS}",
)
calendar_attributes("fn_date_to_sk", "date_sk")
for _grain in ("year", "month", "quarter"):
    of_days(
        f"fn_trunc_{_grain}",
        {"period_start": (lambda g=_grain: dates.period_start(day(), g), f"CAST(date_trunc('{_grain}', d) AS DATE)")},
    )
calendar_attributes("fn_last_day", "last_day_of_month")
calendar_attributes(
    "fn_quarter_bounds", "first_day_of_month", "last_day_of_month", "first_day_of_quarter", "last_day_of_quarter"
)
calendar_attributes("fn_date_parts", "day_of_month", "month_num", "quarter_num", "year_num", "day_of_year")
calendar_attributes("fn_day_of_week", "day_of_week_num")
calendar_attributes("fn_iso_week", "week_of_year", "iso_week_number")
calendar_attributes(
    "fn_date_names", "day_of_week_name", "day_of_week_abbr", "month_name", "month_abbr", "month_year", "quarter_name"
)
calendar_attributes(
    "fn_fiscal_calendar", "fiscal_week_num", "fiscal_month_num", "fiscal_quarter_num", "fiscal_year_num", "fiscal_quarter_name"
)
calendar_attributes("fn_retail_calendar", "retail_period_num", "retail_week_num", "retail_year_num")
calendar_attributes("fn_season", "season")
calendar_attributes("fn_holiday", "is_holiday", "holiday_name")
calendar_attributes(
    "fn_calendar_flags", "is_weekday", "is_weekend", "is_black_friday", "is_cyber_monday", "is_back_to_school"
)
of_days("fn_date_add", {"due_date": (lambda: F.date_add(day(), 30), "CAST(d + INTERVAL 30 DAY AS DATE)")})


def of_sales(name: str, inputs: tuple[str, ...], columns: dict[str, tuple]) -> None:
    add(
        name,
        lambda s: s.sales("transaction_sk", *inputs).select("transaction_sk", *[c().alias(n) for n, (c, _) in columns.items()]),
        f"SELECT transaction_sk, {', '.join(f'{q} AS {n}' for n, (_, q) in columns.items())} FROM c_sales",
    )


def col(name: str) -> Column:
    return F.col(name)


of_sales(
    "fn_coalesce", ("customer_sk", "promotion_sk"),
    {
        "customer_sk": (lambda: F.coalesce(col("customer_sk"), F.lit(0)), "coalesce(customer_sk, 0)"),
        "promotion_sk": (lambda: F.coalesce(col("promotion_sk"), F.lit(0)), "coalesce(promotion_sk, 0)"),
    },
)
of_sales(
    "fn_nullif_divide", ("tax_amount", "discount_amount"),
    {
        "tax_per_discount": (
            lambda: ratios.ratio(col("tax_amount"), col("discount_amount")),
            "CAST(tax_amount AS DOUBLE) / nullif(CAST(discount_amount AS DOUBLE), 0)",
        )
    },
)
of_sales(
    "fn_round", ("net_revenue", "net_revenue_usd"),
    {
        "revenue_2": (lambda: F.round("net_revenue", 2), "CAST(round(net_revenue, 2) AS DECIMAL(13,2))"),
        "share_4": (
            lambda: ratios.round_half_up(ratios.ratio(col("net_revenue_usd"), col("net_revenue")), 4),
            half_up("CAST(net_revenue_usd AS DOUBLE) / nullif(CAST(net_revenue AS DOUBLE), 0)", 4),
        ),
    },
)
of_sales(
    "fn_cast_double", ("quantity_sold", "line_number"),
    {
        "units_per_line": (
            lambda: col("quantity_sold").cast("double") / col("line_number").cast("double"),
            "CAST(quantity_sold AS DOUBLE) / CAST(line_number AS DOUBLE)",
        )
    },
)
of_sales(
    "fn_least_greatest", ("discount_amount", "gross_margin"),
    {
        "capped_discount": (
            lambda: F.least(col("discount_amount"), F.lit(100).cast("decimal(12,4)")),
            "CAST(least(discount_amount, 100) AS DECIMAL(12,4))",
        ),
        "margin_above": (
            lambda: F.greatest(F.lit(0).cast("decimal(15,4)"), col("gross_margin") - F.lit(5000)).cast("decimal(14,4)"),
            "CAST(greatest(0, gross_margin - 5000) AS DECIMAL(14,4))",
        ),
    },
)
add(
    "fn_sha256",
    lambda s: s.raw("customer").select("c_custkey", text.sha256_hex(F.col("c_name")).alias("name_hash")),
    "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer",
)
add(
    "fn_record_checksum",
    lambda s: s.customers("customer_sk", "record_checksum"),
    "SELECT customer_sk, record_checksum FROM c_customers",
)
add("fn_uuid", lambda s: s.raw("orders").select("o_orderkey", F.uuid().alias("row_id")))
add("fn_current_timestamp", lambda s: s.raw("orders").select("o_orderkey", F.current_timestamp().alias("load_timestamp")))


@query(
    "fn_zero_pad_key",
    f"""SELECT p_partkey, 'SKU-FW-' || {pad('p_partkey', 6)} AS sku, 'STR-US-' || {pad('p_partkey', 5)} AS store_key,
  'EMP-' || {pad('p_partkey', 6)} AS employee_key, 'PROMO-' || {pad('p_partkey', 5)} AS promotion_key FROM part""",
)
def zero_pad(s: Star) -> DataFrame:
    key = F.col("p_partkey")
    return s.raw("part").select(
        key,
        text.zero_padded_key("SKU-FW-", key, 6).alias("sku"),
        text.zero_padded_key("STR-US-", key, 5).alias("store_key"),
        text.zero_padded_key("EMP-", key, 6).alias("employee_key"),
        text.zero_padded_key("PROMO-", key, 5).alias("promotion_key"),
    )


add(
    "fn_short_code",
    lambda s: s.raw("part").select("p_partkey", text.short_code(F.col("p_name")).alias("code")),
    "SELECT p_partkey, upper(substr(p_name, 1, 3)) AS code FROM part",
)
add(
    "fn_title_from_code",
    lambda s: s.stores("store_sk", "store_format").withColumn("title", text.title_from_code(F.col("store_format"))),
    f"SELECT store_sk, store_format, {title('store_format')} AS title FROM c_stores",
)
add(
    "fn_split_first",
    lambda s: s.products("product_sk", "colorway").withColumn("main_color", text.split_first(F.col("colorway"))),
    "SELECT product_sk, colorway, string_split(colorway, '/')[1] AS main_color FROM c_products",
)
add(
    "fn_concat",
    lambda s: s.products("product_sk", "product_name", "product_description"),
    "SELECT product_sk, product_name, product_description FROM c_products",
)
add(
    "fn_code_lookup",
    lambda s: s.sales("transaction_sk", "product_sk", "currency_code").select(
        "transaction_sk",
        text.code_lookup(
            F.element_at(
                F.array(*[F.lit(r) for r in params.RETURN_REASONS]), (F.pmod("product_sk", F.lit(8)) + 1).cast("int")
            ),
            params.RETURN_REASONS,
        ).alias("reason"),
        exchange_rate(F.col("currency_code")).alias("rate"),
    ),
    f"SELECT transaction_sk, {pick(REASON_TEXTS, 'product_sk')} AS reason, exchange_rate AS rate FROM c_sales",
)
assert tuple(params.RETURN_REASONS) == REASONS
