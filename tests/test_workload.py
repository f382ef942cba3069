"""Registered queries against their SQL texts on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from shelfline.metrics.layers import METRIC_VIEW, SEMANTIC_LAYER
from shelfline.schemas import TABLES as SCHEMAS
from workload.compare import TABLES, rows_of
from workload.registry import ENTRIES
from workload.star import Star

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

CHECKED = (
    "q_rollup_revenue", "q_non_additive_ratios", "q_hierarchy_grouping_sets", "q_net_after_returns", "q_mv_atomic",
    "q_mv_kpi_board", "q_mv_trailing_by_store", "q_sl_ytd_by_month", "q_sl_dod_by_day", "build_fact_sales",
    "build_fact_web_sessions", "dq_foreign_keys", "metric_windowed_with_plain", "join_entity", "guest_sentinel",
    "metric_filtered_by_entity", "metric_query_or", "metric_query_semi_join", "agg_distinct_over_days", "agg_distinct_rollup",
    "join_parent_hierarchy", "join_conversion_attribution", "join_semi_flag", "join_return_to_sale", "load_tables_from_csv",
    "load_row_count_report", "kpi_inventory", "agg_latest_snapshot",
)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def compare(spark, tables, name):
    df = ENTRIES[name].run(Star(spark, FOLDER))
    cur = tables.execute(ENTRIES[name].oracle)
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


@needs_tables
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, tables, name):
    compare(spark, tables, name)


@needs_tables
@pytest.mark.parametrize("name", ("q_mv_atomic", "join_entity", "guest_sentinel", "join_range_promotion", "q_net_after_returns"))
def test_query_matches_sql_without_broadcasts(spark, tables, no_broadcast, name):
    compare(spark, tables, name)


@needs_tables
@pytest.mark.parametrize("name", ("metric_catalog", "metric_format"))
def test_whole_catalog(spark, tables, name):
    compare(spark, tables, name)
    rows = ENTRIES[name].run(Star(spark, FOLDER)).select("layer", "name").distinct().collect()
    entries = [(e, m) for e in (METRIC_VIEW, SEMANTIC_LAYER) for m in e.metrics.values()]
    want = {(e.name, m.name) for e, m in entries if name == "metric_catalog" or m.format}
    if name == "metric_catalog":
        want |= {(e.name, d) for e in (METRIC_VIEW, SEMANTIC_LAYER) for d in e.dimensions}
    assert {tuple(r) for r in rows} == want


@needs_tables
@pytest.mark.parametrize("name", ("dq_not_null", "dq_allowed_values", "dq_primary_key"))
def test_checks_of_all_tables(spark, tables, name):
    compare(spark, tables, name)
    if name != "dq_allowed_values":
        found = ENTRIES[name].run(Star(spark, FOLDER)).select("table_name").distinct().collect()
        assert {r.table_name for r in found} >= set(SCHEMAS)


@needs_tables
def test_no_job_runs_while_a_plan_is_built(spark):
    """Apart from queries that store a table of their own."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    for name in ("q_mv_atomic", "q_rollup_revenue", "build_fact_sales", "build_dim_store", "join_star_inner", "returns_build"):
        ENTRIES[name].run(Star(spark, FOLDER))
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("tests", "tests")


def scans(df, table):
    """How often an executed plan reads a table's files."""
    return df._jdf.queryExecution().executedPlan().toString().count(f"{table}.parquet")


@needs_tables
def test_facts_are_read_once(spark, monkeypatch):
    from shelfline.metrics import query

    read = []
    real = query.stored
    monkeypatch.setattr(query, "stored", lambda df, purpose: read.append(df) or real(df, purpose))
    for name, layers in (("metric_catalog", 2), ("metric_offset", 1), ("metric_windowed_with_plain", 1)):
        read.clear()
        answer = ENTRIES[name].run(Star(spark, FOLDER))
        assert scans(answer, "lineitem") == 0
        assert sum(scans(df, "lineitem") for df in read) == layers
    read.clear()
    assert scans(ENTRIES["q_mv_ytd"].run(Star(spark, FOLDER)), "lineitem") == 1
    # sums with one kind of count, and another kind over trailing days
    assert scans(ENTRIES["q_mv_kpi_board"].run(Star(spark, FOLDER)), "lineitem") == 2 and not read
    for name in ("q_mv_composed", "q_sl_return_rate_by_month", "metric_filtered"):
        answer = ENTRIES[name].run(Star(spark, FOLDER))
        assert scans(answer, "lineitem") == 1 and "Expand" not in answer._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_transactions_are_counted_where_lines_met_orders(spark, monkeypatch):
    from shelfline.operators import joins

    monkeypatch.setattr(joins, "TASK_BYTES", 1)  # lines and orders are dealt by the order
    plan = ENTRIES["q_mv_kpi_board"].run(Star(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert any("l_orderkey" in line for line in dealt)
    assert not any("_member_transaction_id" in line for line in dealt)
    assert "_sum_trailing_7d_revenue" not in plan  # five metrics sum one column


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {n for n in contract.ENTRIES if n not in contract.oracle_sql()} == {"fn_uuid", "fn_current_timestamp"}


@needs_tables
def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_calendar_follows_the_data(spark, tmp_path):
    """Sales before 1995 and after 2001 are within the calendar, whose ends come from the data."""
    from datetime import date, datetime

    from workload.star import Star

    orders = [(1, 1, "O", 1.0, datetime(1993, 5, 4), "1"), (2, 1, "O", 1.0, datetime(2007, 2, 3), "1")]
    lines = [(k, 1, 1, 1, 2.0, 3.0, 0.0, 0.0, "N", "O", datetime(2008, 1, 1)) for k in (1, 2)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    star = Star(spark, str(tmp_path))
    ends = spark.range(1).select(star.epoch, star.horizon, star.calendar_end).first()
    assert tuple(ends) == (date(1993, 1, 1), date(2007, 2, 3), date(2008, 12, 31))
    days = star.dates("full_date")
    assert days.count() == (date(2008, 12, 31) - date(1993, 1, 1)).days + 1
