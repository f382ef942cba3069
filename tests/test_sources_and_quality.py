from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.quality import checks, kpis
from shelfline.schemas import TABLES
from shelfline.sources import readers, writers
from shelfline.sources.scratch import scratch_folder


def test_schemas_match_the_data_model():
    widths = {name: len(spec.column_names) for name, spec in TABLES.items()}
    assert widths == {
        "fact_sales_transactions": 27, "fact_inventory_snapshot": 20, "dim_customer": 26, "dim_promotion": 23,
        "dim_product": 35, "dim_store": 28, "dim_date": 36, "dim_channel": 8, "dim_employee": 12,
        "dim_geography": 16, "fact_returns": 22, "fact_web_sessions": 23,
    }


def test_every_table_can_be_created_and_dropped(spark, tmp_path):
    for name, spec in TABLES.items():
        assert spec.schema.fieldNames() == spec.column_names
        writers.create_table(spark, spec, f"t_{name}", str(tmp_path / name))
        # partition columns move to the end of the table
        assert sorted(spark.table(f"t_{name}").columns) == sorted(spec.column_names)
    writers.drop_tables(spark, [f"t_{n}" for n in TABLES])
    assert not spark.catalog.tableExists("t_dim_date")


def test_defaults_fill_what_is_missing(spark):
    spec = TABLES["dim_channel"]
    raw = spark.createDataFrame([(1, "A", "Shop", "DIRECT", "STORE", None)],
                                "channel_sk INT, channel_nk STRING, channel_name STRING, channel_category STRING, channel_type STRING, is_owned BOOLEAN")
    row = writers.conform(raw, spec).first()
    assert (row.is_digital, row.is_owned, row.platform_name) == (False, False, None)
    sales = spark.createDataFrame([(None, None, None)], "discount_amount DECIMAL(12,4), return_flag STRING, currency_code STRING")
    filled = writers.apply_defaults(sales, {c: TABLES["fact_sales_transactions"].defaults[c] for c in sales.columns}).first()
    assert tuple(filled) == (Decimal("0.0000"), "N", "USD")


def test_partitioned_overwrite(spark, tmp_path):
    spec = TABLES["dim_date"]
    path = str(tmp_path / "sales")
    df = spark.range(20).select(F.col("id"), (F.col("id") % 3).alias("day"))
    writers.write_parquet(df, path, ["day"])
    writers.write_parquet(df.where("id < 10"), path, ["day"])
    assert spark.read.parquet(path).count() == 10
    assert sorted(p.name for p in (tmp_path / "sales").glob("day=*")) == ["day=0", "day=1", "day=2"]
    assert spec.partition_by == ()


def test_csv_keeps_declared_types(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 2), Decimal("1.5000"), None)], "a BIGINT, d DATE, m DECIMAL(12,4), s STRING")
    writers.write_csv(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert back.schema == df.schema and back.collect() == df.collect()


def test_scratch_folders_are_new(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_row_counts(spark):
    assert {r.table_name: r.cnt for r in readers.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()} == {"a": 3, "b": 0}


def test_foreign_keys(spark):
    tables = {
        "fact_returns": spark.createDataFrame([(20240101, 1, 1, 1, None), (20240102, 2, 1, 9, 5)],
                                              "return_date_sk INT, product_sk BIGINT, store_sk INT, channel_sk INT, customer_sk BIGINT"),
        "dim_date": spark.createDataFrame([(20240101,), (20240102,)], "date_sk INT"),
        "dim_product": spark.createDataFrame([(1,)], "product_sk BIGINT"),
        "dim_customer": spark.createDataFrame([], "customer_sk BIGINT"),
    }
    got = {r.fk_column: (r.orphan_keys, r.is_valid) for r in checks.check_foreign_keys(tables).collect()}
    assert got == {"return_date_sk": (0, True), "product_sk": (1, False), "customer_sk": (1, False)}


def test_keys_nulls_and_values(spark):
    df = spark.createDataFrame([(1, "AMER"), (1, "MOON"), (None, None), (2, "EMEA")], "k INT, region_code STRING")
    row = checks.check_primary_key(df, "t", "k").first()
    assert (row.duplicate_keys, row.surplus_rows, row.null_rows) == (1, 1, 1)
    nulls = {r.column_name: r.null_rows for r in checks.check_not_null(df, "t", ["k", "region_code"]).collect()}
    assert nulls == {"k": 1, "region_code": 1}
    bad = checks.check_allowed_values(df, "t", {"region_code": TABLES["dim_store"].allowed["region_code"]}).collect()
    assert [(r.value, r.row_count) for r in bad] == [("MOON", 1)]


def test_several_keys_of_one_table_take_one_read(spark, tmp_path):
    path = f"{tmp_path}/rows"
    spark.createDataFrame([(1, "x", None), (1, "x", 5), (None, "y", 5), (2, None, 5)], "k INT, t STRING, c INT").write.parquet(path)
    df, other = spark.read.parquet(path), spark.createDataFrame([(7,)], "k INT")
    found = checks.check_primary_keys({"k": (df, "k"), "other": (other, "k"), "pair": (df, ["k", "t"]), "c": (df, "c")})
    assert {(r.table_name, r.duplicate_keys, r.surplus_rows, r.null_rows) for r in found.collect()} == {
        ("k", 1, 1, 1), ("other", 0, 0, 0), ("pair", 1, 1, 2), ("c", 1, 2, 1),
    }
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_conversion_flags(spark):
    df = spark.createDataFrame([(1, True, 5), (2, True, None), (3, False, None)],
                               "id INT, purchase_completed_flag BOOLEAN, purchase_transaction_sk BIGINT")
    assert [r.id for r in checks.check_conversions(df).collect()] == [2]


def test_kpis_of_nothing(spark):
    sales = spark.createDataFrame([], "transaction_id STRING, gross_margin DECIMAL(14,4), net_revenue DECIMAL(14,4), discount_amount DECIMAL(12,4), gross_revenue DECIMAL(14,4)")
    row = kpis.kpi_profitability(sales).first()
    assert (row.gross_margin_pct, row.avg_order_value, row.transaction_count) == (0.0, 0.0, 0)
    assert kpis.kpi_returns(sales, spark.createDataFrame([], "refund_amount DECIMAL(14,4)")).first().return_rate_pct is None


def sales_rows(spark):
    """Twelve priced lines on three days, in the declared shape."""
    base = spark.range(12).select(
        F.col("id").alias("transaction_sk"),
        F.concat(F.lit("t"), F.floor(F.col("id") / 2)).alias("transaction_id"),
        (F.col("id") % 2 + 1).alias("line_number"),
        F.element_at(F.array(F.lit(20240530), F.lit(20240531), F.lit(20240601)), (F.col("id") % 3 + 1).cast("int")).alias("transaction_date_sk"),
        F.lit(7).alias("product_sk"), F.lit(1).alias("store_sk"), F.lit(1).alias("channel_sk"),
        *[F.lit(10).alias(c) for c in (
            "unit_retail_price", "unit_cost_price", "gross_revenue", "net_revenue", "total_transaction_amount",
            "cost_of_goods_sold", "gross_margin", "net_revenue_usd",
        )],
        F.lit("POS_SYSTEM").alias("source_system"),
    )
    return writers.conform(base, TABLES["fact_sales_transactions"])


def test_date_bounds_prune_partitions_of_the_stored_fact(spark, tmp_path):
    from shelfline.metrics.layers import METRIC_VIEW
    from shelfline.metrics.model import Condition, Sources
    from shelfline.metrics.query import metric_query
    from shelfline.plans.staging import stg_fact_sales

    spec = TABLES["fact_sales_transactions"]
    writers.write_star({spec.name: sales_rows(spark)}, str(tmp_path))
    staged = stg_fact_sales(readers.read_star_table(spark, str(tmp_path), spec.name))
    answer = metric_query(
        METRIC_VIEW, Sources(lambda c: staged.select(*c), {}), ["total_net_revenue", "transaction_count"],
        ["transaction_date"], where=[Condition("transaction_date", ">=", date(2024, 6, 1))],
    )
    assert [(r.transaction_date, r.total_net_revenue, r.transaction_count) for r in answer.collect()] == [
        (date(2024, 6, 1), Decimal("40.0000"), 4)
    ]
    plan = answer._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    # the bound on the derived date has become a filter on the partition column
    assert "cast(transaction_date_sk" in filters


def test_load_job(spark, tmp_path):
    """Files list the partition column first; the table keeps it last."""
    from shelfline.sources.load import load_csv_tables

    spec = TABLES["fact_sales_transactions"]
    writers.create_table(spark, spec, "loaded_sales", str(tmp_path / "table"))
    rows = sales_rows(spark)
    assert spark.table("loaded_sales").columns != rows.columns
    writers.write_csv(rows, str(tmp_path / "csv"))
    for _ in range(2):
        report = load_csv_tables(spark, {"loaded_sales": str(tmp_path / "csv")}, {"loaded_sales": spec.partition_by})
        assert [tuple(r) for r in report.collect()] == [("loaded_sales", 12)]
    back = spark.table("loaded_sales").select(*rows.columns).orderBy("transaction_sk")
    kept = [c for c in rows.columns if c != "load_timestamp"]
    assert back.select(*kept).collect() == rows.orderBy("transaction_sk").select(*kept).collect()
    writers.drop_tables(spark, ["loaded_sales"])


def test_csv_header_must_match(spark, tmp_path):
    import pytest

    spark.range(2).select(F.col("id").alias("b"), F.lit(1).alias("a")).write.option("header", True).csv(str(tmp_path / "c"))
    schema = spark.createDataFrame([], "a INT, b BIGINT").schema
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "c"), schema).collect()


def test_tables_of_a_star_are_written_side_by_side(monkeypatch):
    from threading import Barrier

    from shelfline.sources import writers

    both, done = Barrier(2), []

    def write(df, path, partition_by=()):
        both.wait(timeout=20)
        done.append((df, path, tuple(partition_by)))

    monkeypatch.setattr(writers, "write_parquet", write)
    writers.write_star({"dim_store": "a", "dim_date": "b"}, "root")
    assert sorted(done) == [("a", "root/dim_store", ("region_code",)), ("b", "root/dim_date", ())]
