from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.metrics.catalog import lookup_terms, metric_catalog
from shelfline.metrics.formatting import format_value
from shelfline.metrics.layers import METRIC_VIEW, SEMANTIC_LAYER
from shelfline.metrics.model import Condition, Derived, Format, Input, Sources
from shelfline.metrics.query import metric_query

DAY0 = date(2023, 12, 28)
READ: list[list[str]] = []

FACT = """transaction_id STRING, line INT, transaction_date DATE, store_sk INT, product_sk INT, customer_sk BIGINT,
  net_revenue_usd DECIMAL(14,4), gross_revenue DECIMAL(14,4), cost_of_goods_sold DECIMAL(14,4),
  discount_amount DECIMAL(12,4), quantity_sold INT, return_flag STRING, revenue_tier STRING"""


def line(txn, n, day, store, product, customer, net, returned="N"):
    net = Decimal(net)
    return (txn, n, DAY0 + timedelta(days=day), store, product, customer, net, net + 1, net / 2, Decimal(1), 2, returned, "Low-Value")


ROWS = [
    line("t1", 1, 0, 1, 1, 10, "100"),
    line("t1", 2, 0, 1, 2, 10, "50", "Y"),
    line("t2", 1, 0, 2, 1, None, "30"),
    line("t3", 1, 1, 1, 1, 11, "20"),
    line("t4", 1, 5, 1, 1, 10, "10"),
    line("t5", 1, 40, 3, 1, 12, "7"),  # store 3 has no dimension row
]


@pytest.fixture(scope="module")
def sources(spark):
    fact = spark.createDataFrame(ROWS, FACT)
    stores = spark.createDataFrame([(1, "North", "A"), (2, "South", "B")], "store_sk INT, region_name STRING, store_name STRING")
    products = spark.createDataFrame([(1, "Shoes"), (2, "Bags")], "product_sk INT, category_name STRING")

    def pick(df):
        def read(columns):
            READ.append(columns)
            return df.select(*columns)

        return read

    return Sources(pick(fact), {"store": pick(stores), "product": pick(products), "customer": pick(fact)})


def run(sources, metrics, group_by=(), layer=METRIC_VIEW, **more):
    return metric_query(layer, sources, metrics, group_by, **more).collect()


def test_filtered_metric_leaves_others_alone(sources):
    rows = {r.region_name: r for r in run(sources, ["transaction_count", "return_transactions", "return_rate", "unique_customers"], ["region_name"])}
    assert (rows["North"].transaction_count, rows["North"].return_transactions) == (3, 1)
    assert rows["North"].return_rate == pytest.approx(1 / 3)
    assert rows["South"].unique_customers == 0
    assert rows[None].transaction_count == 1


def test_totals_do_not_depend_on_the_dimensions(sources):
    total = run(sources, ["total_net_revenue"])[0].total_net_revenue
    for keys in (["region_name"], ["category_name"], ["region_name", "category_name", "transaction_date"]):
        assert sum(r.total_net_revenue for r in run(sources, ["total_net_revenue"], keys)) == total == Decimal("217.0000")


def test_only_needed_tables_and_columns_are_read(sources):
    READ.clear()
    run(sources, ["total_net_revenue"], ["region_name"])
    assert READ == [["net_revenue_usd", "store_sk", "transaction_date"], ["store_sk", "region_name"]]


def test_windows_see_history_before_the_date_filter(sources):
    late = [Condition("transaction_date", ">=", DAY0 + timedelta(days=1))]
    metrics = ["trailing_7d_revenue", "trailing_7d_customers", "cumulative_revenue", "previous_day_revenue", "ytd_revenue"]
    after = {r.transaction_date: r for r in run(sources, metrics, ["transaction_date"], where=late)}
    first = after[DAY0 + timedelta(days=1)]
    assert first.trailing_7d_revenue == first.previous_day_revenue == 180
    assert first.trailing_7d_customers == 1
    assert first.cumulative_revenue == 200
    new_year = after[DAY0 + timedelta(days=5)]
    assert new_year.ytd_revenue == 10 and new_year.previous_day_revenue is None
    assert new_year.trailing_7d_customers == 2
    before = {r.transaction_date: r for r in run(sources, metrics, ["transaction_date"], where=late, date_filter="before")}
    assert before[DAY0 + timedelta(days=1)].trailing_7d_revenue is None
    assert before[DAY0 + timedelta(days=5)].cumulative_revenue == 30


def test_trailing_history_is_cut_but_enough(sources):
    """Only the days a trailing window can reach are read; results stay the same."""
    where = [Condition("transaction_date", ">=", DAY0 + timedelta(days=5))]
    cut = run(sources, ["trailing_7d_revenue", "trailing_7d_customers"], ["transaction_date", "region_name"], where=where)
    whole = [
        r for r in run(sources, ["trailing_7d_revenue", "trailing_7d_customers"], ["transaction_date", "region_name"])
        if r.transaction_date >= DAY0 + timedelta(days=5)
    ]
    assert sorted(map(str, cut)) == sorted(map(str, whole))
    plan = metric_query(METRIC_VIEW, sources, ["trailing_7d_revenue"], ["transaction_date"], where=where)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert str(DAY0 + timedelta(days=5 - 7)) in text


def test_semiadditive_value_is_the_last_day(sources):
    rows = {r.region_name: r for r in run(sources, ["cumulative_revenue", "current_day_revenue", "total_net_revenue"], ["region_name"])}
    assert rows["North"].cumulative_revenue == 180
    assert rows["North"].current_day_revenue == 10
    assert rows["North"].total_net_revenue == 180
    total = run(sources, ["cumulative_revenue"])
    assert [r.cumulative_revenue for r in total] == [217]


def test_last_running_total_is_the_total(sources):
    rows = run(sources, ["cumulative_revenue"], ["transaction_date"])
    assert max(rows, key=lambda r: r.transaction_date).cumulative_revenue == 217


def test_spine_fills_days_and_growth_is_null_without_a_day_before(sources):
    names = ["trailing_7d_revenue", "day_over_day_revenue_growth", "cumulative_revenue"]
    rows = {r.metric_time__day: r for r in run(sources, names, ["metric_time__day"], SEMANTIC_LAYER)}
    assert len(rows) == 41
    second = rows[DAY0 + timedelta(days=1)]
    assert second.day_over_day_revenue_growth == pytest.approx((20 - 180) / 180 * 100)
    assert second.trailing_7d_revenue == 200
    gap = rows[DAY0 + timedelta(days=20)]
    assert gap.trailing_7d_revenue is None and gap.cumulative_revenue == 210
    assert rows[DAY0 + timedelta(days=5)].day_over_day_revenue_growth is None


def test_all_groups_have_the_same_days(sources):
    rows = run(sources, ["cumulative_revenue"], ["metric_time__day", "store__region_name"], SEMANTIC_LAYER)
    assert len(rows) == 3 * 41
    last = {r.store__region_name: r.cumulative_revenue for r in rows if r.metric_time__day == DAY0 + timedelta(days=40)}
    assert last == {"North": 180, "South": 30, None: 7}
    first = {r.store__region_name: r.cumulative_revenue for r in rows if r.metric_time__day == DAY0}
    assert first == {"North": 150, "South": 30, None: None}


def earlier(metric, days):
    moved = Derived("moved", "Moved", inputs=(Input(metric, days_ago=days),))
    return replace(SEMANTIC_LAYER, metrics=SEMANTIC_LAYER.metrics | {"moved": moved})


def test_offsets_of_composed_and_windowed_metrics(sources):
    rows = {r.metric_time__day: r.moved for r in run(sources, ["moved"], ["metric_time__day"], earlier("gross_margin", 1))}
    assert rows[DAY0 + timedelta(days=1)] == 90 and rows[DAY0 + timedelta(days=2)] == 10 and rows[DAY0] is None
    rows = {r.metric_time__day: r.moved for r in run(sources, ["moved"], ["metric_time__day"], earlier("cumulative_revenue", 2))}
    assert rows[DAY0 + timedelta(days=2)] == 180 and rows[DAY0 + timedelta(days=40)] == 210


def test_shifted_count_at_a_coarser_grain_counts_once(sources):
    rows = {r.metric_time__year: r.moved for r in run(sources, ["moved"], ["metric_time__year"], earlier("unique_customers", 1))}
    assert rows == {date(2023, 1, 1): 2, date(2024, 1, 1): 1}


def test_history_is_cut_for_dates_as_text(sources):
    day = DAY0 + timedelta(days=5)
    plan = metric_query(METRIC_VIEW, sources, ["trailing_7d_revenue"], ["transaction_date"], where=[Condition("transaction_date", ">=", str(day))])
    assert str(day - timedelta(days=7)) in plan._jdf.queryExecution().optimizedPlan().toString()


def test_coarser_grain(sources):
    rows = {r.metric_time__month: r for r in run(sources, ["ytd_revenue", "total_net_revenue"], ["metric_time__month"], SEMANTIC_LAYER)}
    assert rows[date(2023, 12, 1)].ytd_revenue == 200
    assert rows[date(2024, 1, 1)].ytd_revenue == 10
    assert rows[date(2024, 2, 1)].ytd_revenue == 17
    assert rows[date(2024, 2, 1)].total_net_revenue == 7


def test_zero_denominators(spark):
    empty = spark.createDataFrame([line("t", 1, 0, 1, 1, 1, "0")], FACT).withColumn("quantity_sold", F.lit(0))
    row = run(Sources(lambda c: empty.select(*c), {}), ["gross_margin_pct", "avg_selling_price", "avg_order_value"])[0]
    assert (row.gross_margin_pct, row.avg_selling_price, row.avg_order_value) == (None, None, 0.0)


def test_names_labels_and_synonyms(spark, sources):
    rows = run(sources, {"money": "Net Sales"}, {"place": "geography"}, where=[Condition("region", "in", ["North"])])
    assert [(r.place, r.money) for r in rows] == [("North", Decimal("180.0000"))]
    with pytest.raises(KeyError):
        run(sources, ["no such thing"])
    asked = spark.createDataFrame([("AOV",), ("nothing",)], "term STRING")
    found = {r.term: r.name for r in lookup_terms(asked, metric_catalog(spark, METRIC_VIEW)).collect()}
    assert found == {"AOV": "avg_order_value", "nothing": None}


def test_layers_declare_what_they_should():
    assert len(METRIC_VIEW.metrics) == 21
    assert len(SEMANTIC_LAYER.metrics) == 19


def test_formats(spark):
    cases = [
        (1234567.891, Format("currency", "USD", 2, compact=True), "$1.23M"),
        (1234.5, Format("currency", "USD", 2), "$1,234.50"),
        (0.0512, Format("percentage", places=2, fraction=True), "5.12%"),
        (55.326, Format("percentage", places=2), "55.33%"),
        (1234567.0, Format("number", places=0), "1,234,567"),
        (-2500.0, Format("currency", "EUR", 1, compact=True), "€-2.5K"),
        (999999.0, Format("number", places=2, compact=True), "1.00M"),
        (995000.0, Format("number", places=2, compact=True), "995.00K"),
        (999.999, Format("number", places=2, compact=True), "1.00K"),
        (1234.5, Format("number"), "1,234.5"),
        (DAY0, Format("date"), "2023-12-28"),
    ]
    for value, how, text in cases:
        assert spark.range(1).select(format_value(F.lit(value), how).alias("v")).first().v == text
