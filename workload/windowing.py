"""Calendar windows, semi-additive values and ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import period_start
from shelfline.functions.ratios import growth_percent, money_sum
from shelfline.metrics.layers import SEMANTIC_LAYER
from shelfline.metrics.query import metric_query
from shelfline.operators import sampling, windows
from shelfline.operators.ordinals import ordinal_within
from workload.joining import CHANNEL_DAYS, CHANNEL_SPINE, channel_days
from workload.oracle import money
from workload.published import D244, INVENTORY_SQL, LAST_1, LAST_7, SO_FAR, inventory_report, over, ratio
from workload.registry import add, query
from workload.star import Star

KEYS, DAY = ["channel_sk"], "transaction_date"
DAILY = f"(SELECT channel_sk, transaction_date, {money('gross_revenue')} AS revenue FROM c_sales GROUP BY 1, 2)"


def daily(s: Star) -> DataFrame:
    """Gross revenue per channel and day; several channels have gaps."""
    return s.sales("channel_sk", DAY, "gross_revenue").groupBy("channel_sk", DAY).agg(
        money_sum("gross_revenue").alias("revenue")
    )


def windowed(name: str, column, frame: str, by: str = "channel_sk") -> None:
    add(
        name,
        lambda s: daily(s).withColumn("value", column().cast("decimal(24,4)")),
        f"SELECT *, {D244.format('sum(revenue) ' + over(by, frame))} AS value FROM {DAILY}",
    )


windowed("win_trailing_sum_exclusive", lambda: windows.trailing("revenue", KEYS, DAY, 7), LAST_7)
windowed(
    "win_trailing_sum_inclusive", lambda: windows.trailing("revenue", KEYS, DAY, 7, include_today=True),
    "INTERVAL 6 DAY PRECEDING AND CURRENT ROW",
)
windowed("win_current", lambda: F.col("revenue"), "CURRENT ROW AND CURRENT ROW")
windowed("win_previous_day", lambda: windows.trailing("revenue", KEYS, DAY, 1), LAST_1)
windowed("win_cumulative_sum", lambda: windows.running_total("revenue", KEYS, DAY), SO_FAR)
windowed(
    "win_period_to_date", lambda: windows.period_to_date("revenue", KEYS, DAY, "quarter"), SO_FAR,
    "channel_sk, date_trunc('quarter', transaction_date)",
)


@query(
    "win_trailing_distinct",
    f"""SELECT a.channel_sk, a.transaction_date, a.revenue, count(DISTINCT b.customer_sk) AS customers FROM {DAILY} a
LEFT JOIN (SELECT DISTINCT channel_sk, transaction_date, customer_sk FROM c_lines) b ON a.channel_sk = b.channel_sk
  AND b.transaction_date BETWEEN a.transaction_date - INTERVAL 7 DAY AND a.transaction_date - INTERVAL 1 DAY GROUP BY 1, 2, 3""",
)
def trailing_distinct(s: Star) -> DataFrame:
    facts = s.sales("channel_sk", DAY, "customer_sk")
    return windows.with_trailing_distinct(daily(s), facts, KEYS, DAY, "customer_sk", 7, "customers")


@query(
    "win_offset",
    f"""SELECT channel_sk, date_day, units, CAST(sum(units) OVER (PARTITION BY channel_sk ORDER BY date_day
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS BIGINT) AS units_week_before
FROM {CHANNEL_SPINE} LEFT JOIN {CHANNEL_DAYS} USING (channel_sk, date_day)""",
)
def offset(s: Star) -> DataFrame:
    full = windows.fill_days(channel_days(s), "date_day", KEYS)
    return full.withColumn("units_week_before", windows.value_days_ago("units", KEYS, "date_day", 7))


@query(
    "win_day_over_day_growth",
    f"""SELECT channel_sk, transaction_date, revenue, prev, (CAST(revenue AS DOUBLE) - CAST(prev AS DOUBLE))
  / nullif(CAST(prev AS DOUBLE), 0) * 100 AS growth_pct
FROM (SELECT *, {D244.format('sum(revenue) ' + over("channel_sk", LAST_1))} AS prev FROM {DAILY})""",
)
def growth(s: Star) -> DataFrame:
    before = windows.value_days_ago("revenue", KEYS, DAY, 1).cast("decimal(24,4)")
    return daily(s).withColumn("prev", before).withColumn("growth_pct", growth_percent(F.col("revenue"), F.col("prev")))


RUNNING = f"SELECT *, {D244.format('sum(revenue) ' + over('channel_sk', SO_FAR))} AS total FROM {DAILY}"
add(
    "win_semiadditive_last",
    lambda s: windows.last_in_group(
        daily(s).withColumn("total", windows.running_total("revenue", KEYS, DAY).cast("decimal(24,4)")),
        KEYS, DAY, ["revenue", "total"],
    ),
    f"""SELECT channel_sk, arg_max(revenue, transaction_date) AS revenue, arg_max(total, transaction_date) AS total
FROM ({RUNNING}) GROUP BY 1""",
)


@query(
    "win_cumulative_at_coarser_grain",
    f"""SELECT channel_sk, CAST(date_trunc('month', transaction_date) AS DATE) AS month,
  arg_max(total, transaction_date) AS total FROM ({RUNNING}) GROUP BY 1, 2""",
)
def coarser(s: Star) -> DataFrame:
    days = daily(s).withColumns(
        {
            "total": windows.running_total("revenue", KEYS, DAY).cast("decimal(24,4)"),
            "month": period_start(F.col(DAY), "month"),
        }
    )
    return windows.last_in_group(days, ["channel_sk", "month"], DAY, ["total"])


add("semi_period_end_inventory", inventory_report, INVENTORY_SQL)

add(
    "rank_row_number_per_day",
    lambda s: ordinal_within(
        s.funnels().where("purchase_completed_flag").select("session_date", "session_sk"), ["session_date"], "session_sk"
    ),
    """SELECT session_date, session_sk, row_number() OVER (PARTITION BY session_date ORDER BY session_sk) AS ordinal
FROM c_funnels WHERE purchase_completed_flag""",
)
add(
    "rank_every_nth_date",
    lambda s: s.sales("transaction_sk", DAY).where(sampling.every_nth_day(F.col(DAY), F.lit(s.epoch), 7)),
    "SELECT transaction_sk, transaction_date FROM c_lines WHERE (transaction_date - (SELECT first_day FROM c_span)) % 7 = 0",
)

# --- the same through the metric layer ---------------------------------------------------

MARGIN = ratio("sum(net_revenue_usd) - sum(cost_of_goods_sold)", "sum(net_revenue_usd)") + " * 100"
add(
    "metric_windowed_with_plain",
    lambda s: metric_query(
        SEMANTIC_LAYER, s.metric_sources(),
        {"ytd": "ytd_revenue", "margin_pct": "gross_margin_pct", "customers": "unique_customers", "t7": "trailing_7d_customers"},
        {"format": "store__store_format", "quarter": "metric_time__quarter"},
    ),
    f"""SELECT a.format, a.quarter, ytd, margin_pct, customers, t7 FROM (
  SELECT store_format AS format, CAST(date_trunc('quarter', transaction_date) AS DATE) AS quarter, {MARGIN} AS margin_pct,
    count(DISTINCT customer_sk) AS customers, max(transaction_date) AS last_day
  FROM c_sales JOIN c_stores USING (store_sk) GROUP BY 1, 2) a
JOIN (SELECT store_format, transaction_date, {D244.format("sum(sum(net_revenue_usd)) OVER (PARTITION BY store_format, year(transaction_date) ORDER BY transaction_date)")} AS ytd
  FROM c_sales JOIN c_stores USING (store_sk) GROUP BY 1, 2) b ON b.store_format = a.format AND b.transaction_date = a.last_day
LEFT JOIN (SELECT x.format, x.quarter, count(DISTINCT customer_sk) AS t7 FROM (SELECT store_format AS format,
    CAST(date_trunc('quarter', transaction_date) AS DATE) AS quarter, least(CAST(date_trunc('quarter', transaction_date)
      + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), max(max(transaction_date)) OVER ()) AS last_day
    FROM c_sales JOIN c_stores USING (store_sk) GROUP BY 1, date_trunc('quarter', transaction_date)) x
  LEFT JOIN (SELECT DISTINCT store_format, transaction_date, customer_sk FROM c_sales JOIN c_stores USING (store_sk)) y
    ON y.store_format = x.format AND y.transaction_date BETWEEN x.last_day - 6 AND x.last_day GROUP BY 1, 2) c
  ON c.format = a.format AND c.quarter = a.quarter""",
)
