"""Scans, sinks, views and filters."""

from __future__ import annotations

from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.metrics.layers import SEMANTIC_LAYER
from shelfline.operators import filters
from shelfline.operators.joins import many_to_one, star_inner
from shelfline.plans import staging
from shelfline.rules import calendar, customers
from shelfline.schemas import TABLES
from shelfline.metrics.query import with_entities
from shelfline.sources import readers, writers
from shelfline.sources.load import load_csv_tables
from shelfline.sources.scratch import scratch_folder, stored
from workload.oracle import money, whole_sql
from workload.registry import add, query
from workload.star import RAW_SCHEMAS, TIERS, Star


def listed(*names: str) -> str:
    return ", ".join(names)


def table_name(purpose: str) -> str:
    return f"{purpose}_{uuid4().hex[:10]}"


def order_rows(s: Star) -> DataFrame:
    return s.raw("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"""


@query("scan_csv_declared_schema", ORDERS_SQL)
def scan_csv(s: Star) -> DataFrame:
    path = scratch_folder(s.spark, "csv_in")
    rows = order_rows(s)
    writers.write_csv(rows, path)
    return readers.read_csv(s.spark, path, writers.nullable(rows.schema))


@query("scan_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_table(s: Star) -> DataFrame:
    name, path = table_name("supplier_copy"), scratch_folder(s.spark, "supplier_copy")
    writers.write_parquet(s.raw("supplier"), path)
    s.spark.sql(f"CREATE TABLE {name} ({RAW_SCHEMAS['supplier']}) USING parquet LOCATION '{path}'")
    return s.spark.table(name)


add("scan_parquet", lambda s: s.raw("part"), "SELECT * FROM part")

STORE_COLUMNS = (
    "store_sk", "store_nk", "store_name", "store_type", "region_code", "country_code", "store_format",
    "is_digital", "is_active", "ownership_model",
)


@query("create_partitioned_table", f"SELECT {listed(*STORE_COLUMNS)} FROM c_stores")
def create_partitioned(s: Star) -> DataFrame:
    spec = TABLES["dim_store"]
    name, path = table_name("dim_store"), scratch_folder(s.spark, "dim_store")
    writers.create_table(s.spark, spec, name, path)
    writers.insert_overwrite(writers.balanced(writers.conform(s.stores(), spec), spec.partition_by), name)
    return s.spark.table(name).select(*STORE_COLUMNS)


@query("drop_if_exists", "SELECT count(*) AS rows_before, FALSE AS exists_after FROM supplier")
def drop_if_exists(s: Star) -> DataFrame:
    name, path = table_name("supplier_gone"), scratch_folder(s.spark, "supplier_gone")
    writers.write_parquet(s.raw("supplier"), path)
    s.spark.sql(f"CREATE TABLE {name} ({RAW_SCHEMAS['supplier']}) USING parquet LOCATION '{path}'")
    counted = readers.read_parquet(s.spark, path, T.StructType.fromDDL(RAW_SCHEMAS["supplier"]))
    writers.drop_tables(s.spark, [name, f"{name}_never_there"])
    return counted.agg(F.count(F.lit(1)).alias("rows_before")).withColumn(
        "exists_after", F.lit(s.spark.catalog.tableExists(name))
    )


@query(
    "apply_column_defaults",
    """SELECT transaction_sk, CAST(coalesce(nullif(discount_amount, 0), 0) AS DECIMAL(12,4)) AS discount_amount,
  coalesce(nullif(return_flag, 'N'), 'N') AS return_flag, coalesce(nullif(currency_code, 'USD'), 'USD') AS currency_code,
  CAST(coalesce(nullif(exchange_rate, 1), 1.0) AS DECIMAL(10,6)) AS exchange_rate FROM c_sales""",
)
def apply_defaults(s: Star) -> DataFrame:
    """Values equal to the default are blanked first, as a source that omits them would."""
    sales = s.sales("transaction_sk", "discount_amount", "return_flag", "currency_code", "exchange_rate")
    sparse = sales.withColumns(
        {
            "discount_amount": F.when(F.col("discount_amount") != 0, F.col("discount_amount")),
            "return_flag": F.nullif("return_flag", F.lit("N")),
            "currency_code": F.nullif("currency_code", F.lit("USD")),
            "exchange_rate": F.when(F.col("exchange_rate") != 1, F.col("exchange_rate")),
        }
    )
    declared = TABLES["fact_sales_transactions"].defaults
    return writers.apply_defaults(sparse, {c: declared[c] for c in sparse.columns if c in declared})


@query("sink_insert_overwrite", ORDERS_SQL)
def insert_overwrite(s: Star) -> DataFrame:
    """The second load replaces the first one; its columns come in another order."""
    rows = order_rows(s)
    name, path = table_name("orders_copy"), scratch_folder(s.spark, "orders_copy")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    s.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    writers.insert_overwrite(rows.where("o_orderstatus = 'O'"), name)
    writers.insert_overwrite(rows.select(*reversed(rows.columns)), name)
    return s.spark.table(name)


# The twelve tables as views of the SQL texts; the last ones lack texts that make no key and no count.
TWELVE = {
    "fact_sales_transactions": "c_promoted", "fact_inventory_snapshot": "c_inventory", "fact_returns": "c_returns",
    "fact_web_sessions": "c_sessions", "dim_customer": "c_customers", "dim_promotion": "c_promotions", "dim_product": "c_products",
    "dim_store": "c_stores", "dim_date": "c_dates", "dim_employee": "c_employees",
    "dim_channel": "(SELECT unnest(range(1, 11)) AS channel_sk)",
    "dim_geography": """(SELECT DISTINCT region_code AS geo_sk FROM c_rawstores UNION ALL SELECT DISTINCT country_name FROM c_rawstores
  UNION ALL SELECT DISTINCT state_code FROM c_rawstores UNION ALL SELECT DISTINCT city FROM c_rawstores)""",
}


@query(
    "sink_parquet_overwrite",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS cnt, count(DISTINCT {TABLES[t].primary_key}) AS key_count FROM {view}" for t, view in TWELVE.items()
    ),
)
def parquet_sink(s: Star) -> DataFrame:
    """All twelve tables, one of them over an earlier write, read back and counted."""
    root = scratch_folder(s.spark, "star")
    tables = {t: s.declared(t) for t in TABLES}
    writers.write_star({"dim_employee": tables["dim_employee"].limit(5)}, root)  # is replaced by the second write
    writers.write_star(tables, root)
    back = [readers.read_parquet(s.spark, f"{root}/{t}", writers.nullable(df.schema)) for t, df in tables.items()]
    keyed = [df.select(F.lit(t).alias("table_name"), F.col(TABLES[t].primary_key).cast("string").alias("key")) for t, df in zip(tables, back, strict=True)]
    return reduce(DataFrame.unionByName, keyed).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("key").alias("key_count")
    )


@query("sink_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def csv_sink(s: Star) -> DataFrame:
    path = scratch_folder(s.spark, "csv_out")
    rows = s.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    writers.write_csv(rows, path)
    return readers.read_csv(s.spark, path, rows.schema)


@query("staging_view", f"SELECT store_sk, {money('net_revenue_usd')} AS revenue FROM c_sales WHERE return_flag = 'N' GROUP BY 1")
def staging_view(s: Star) -> DataFrame:
    name = table_name("stg_sales")
    readers.staging_view(s.sales("store_sk", "return_flag", "net_revenue_usd"), name)
    return s.spark.sql(
        f"SELECT store_sk, CAST(sum(net_revenue_usd) AS DECIMAL(24,4)) AS revenue FROM {name} WHERE return_flag = 'N' GROUP BY store_sk"
    )


add(
    "time_spine_day",
    lambda s: calendar.days_of(order_rows(s), "o_orderdate"),
    """SELECT CAST(x AS DATE) AS date_day FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS x
FROM orders)""",
)

LOADED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LAYOUT = {"orders": ("o_orderstatus",), "lineitem": ("l_returnflag", "l_linestatus"), "events": ("event_type",)}


def loaded_tables(s: Star) -> tuple[dict[str, str], DataFrame]:
    """Every source table as a CSV folder, then by the load job in a declared table, some of them partitioned: the catalog
    name of each, and the job's report under the source names."""
    names, files, layout = {}, {}, {}
    for t in LOADED:
        folder, name = scratch_folder(s.spark, f"{t}_csv"), table_name(t)
        writers.write_csv(s.raw(t), folder)
        by = LAYOUT.get(t, ())
        parts = f"PARTITIONED BY ({', '.join(by)})" if by else ""
        s.spark.sql(f"CREATE TABLE {name} ({RAW_SCHEMAS[t]}) USING parquet {parts} LOCATION '{scratch_folder(s.spark, t)}'")
        names[t], files[name], layout[name] = name, folder, by
    report = load_csv_tables(s.spark, files, layout)
    renamed = s.spark.createDataFrame([(name, t) for t, name in names.items()], "table_name STRING, source STRING")
    return names, report.join(renamed, "table_name").select(F.col("source").alias("table_name"), "cnt")


@query("load_row_count_report", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {t}" for t in LOADED))
def load_report(s: Star) -> DataFrame:
    """What the load job counted while it wrote."""
    names, report = loaded_tables(s)
    writers.drop_tables(s.spark, names.values())
    return report


@query(
    "load_tables_from_csv",
    """SELECT l_returnflag, l_linestatus, o_orderstatus, event_type, count(*) AS line_count, CAST(sum(l_quantity) AS BIGINT) AS units,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS price, count(DISTINCT r_name) AS regions, count(DISTINCT p_brand) AS brands
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN events ON event_id = l_orderkey GROUP BY ALL""",
)
def load_all_tables(s: Star) -> DataFrame:
    """A join over all tables as they were loaded, which are dropped afterwards."""
    names, _ = loaded_tables(s)
    t = {name: s.spark.table(loaded) for name, loaded in names.items()}
    joined = (
        t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("c_custkey") == F.col("o_custkey"))
        .join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
        .join(t["part"], F.col("p_partkey") == F.col("l_partkey"))
        .join(t["supplier"], F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t["events"], F.col("event_id") == F.col("l_orderkey"), "left")
    )
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    answer = stored(
        joined.groupBy("l_returnflag", "l_linestatus", "o_orderstatus", "event_type").agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").cast("bigint").alias("units"),
            (cents / 100).alias("price"), F.count_distinct("r_name").alias("regions"), F.count_distinct("p_brand").alias("brands"),
        ),
        "loaded",
    )
    writers.drop_tables(s.spark, names.values())
    return answer


# --- staging projections ------------------------------------------------------------

add(
    "stg_fact_sales",
    lambda s: staging.stg_fact_sales(s.declared("fact_sales_transactions"), TIERS),
    whole_sql("fact_sales_transactions", "c_promoted", """, transaction_date, CAST(date_trunc('year', transaction_date) AS DATE) AS transaction_year,
  CASE WHEN net_revenue_usd > 30000 THEN 'High-Value' WHEN net_revenue_usd > 10000 THEN 'Mid-Value' ELSE 'Low-Value' END AS revenue_tier"""),
)
add("stg_dim_store", lambda s: staging.stg_dim_store(s.declared("dim_store")), whole_sql("dim_store", "c_stores"))
add("stg_dim_product", lambda s: staging.stg_dim_product(s.declared("dim_product")), whole_sql("dim_product", "c_products"))
add("stg_dim_customer", lambda s: staging.stg_dim_customer(s.declared("dim_customer")), whole_sql("dim_customer", "c_customers"))

# --- filters ---------------------------------------------------------------------------

KEYS = ("transaction_sk", "store_sk", "product_sk")


def filtered(name: str, columns: tuple[str, ...], condition, where: str) -> None:
    """Rows of the sales fact that meet a condition."""
    add(
        name,
        lambda s: s.sales(*KEYS, *columns).where(condition()),
        f"SELECT {listed(*KEYS, *columns)} FROM c_sales WHERE {where}",
    )


filtered("filter_not_null", ("customer_sk",), lambda: F.col("customer_sk").isNotNull(), "customer_sk IS NOT NULL")
filtered("filter_equals", ("return_flag",), lambda: F.col("return_flag") == "N", "return_flag = 'N'")
filtered(
    "filter_date_from", ("transaction_date", "transaction_date_sk"),
    lambda: filters.since(F.col("transaction_date"), date(1998, 1, 1), F.col("transaction_date_sk")),
    "transaction_date >= DATE '1998-01-01'",
)
filtered("filter_in_list", ("channel_sk",), lambda: F.col("channel_sk").isin(2, 3, 4), "channel_sk IN (2, 3, 4)")
filtered(
    "filter_period_end", ("transaction_date",), lambda: filters.at_period_end(F.col("transaction_date")),
    "transaction_date = last_day(transaction_date)",
)
add(
    "filter_boolean",
    lambda s: s.stores("store_sk", "store_name", "is_digital").where(~F.col("is_digital")),
    "SELECT store_sk, store_name, is_digital FROM c_stores WHERE NOT is_digital",
)


@query(
    "filter_entity_dimension",
    "SELECT transaction_sk, country_name FROM c_sales JOIN c_stores USING (store_sk) WHERE country_name = 'NATION_3'",
)
def filter_entity(s: Star) -> DataFrame:
    joined = with_entities(SEMANTIC_LAYER, s.metric_sources(), s.sales(*KEYS), {"store": ["country_name"]})
    return joined.where("_store_country_name = 'NATION_3'").select(
        "transaction_sk", F.col("_store_country_name").alias("country_name")
    )


@query("filter_current_rows", "SELECT customer_sk, customer_nk, is_current_flag FROM c_customers WHERE is_current_flag")
def current_rows(s: Star) -> DataFrame:
    return filters.current_rows(s.customers("customer_sk", "customer_nk", "is_current_flag"))


add(
    "case_revenue_tier",
    lambda s: s.sales("transaction_sk", "net_revenue_usd").withColumn(
        "revenue_tier", filters.revenue_tier(F.col("net_revenue_usd"), TIERS)
    ),
    "SELECT transaction_sk, net_revenue_usd, revenue_tier FROM c_sales",
)


@query(
    "case_channel_assignment",
    """SELECT transaction_sk, l.channel_sk, CASE WHEN s.is_digital THEN '2,3,4' WHEN s.channel_type = 'WHOLESALE' THEN '6,7,8' ELSE '1,5' END
  AS admissible FROM c_lines l JOIN c_stores s USING (store_sk)""",
)
def channel_assignment(s: Star) -> DataFrame:
    stores = s.stores("store_sk", "is_digital", "channel_type")
    joined = star_inner(s.sales("transaction_sk", "store_sk", "order_number"), (stores, "store_sk", "store_sk"))
    options = filters.admissible_channels(F.col("is_digital"), F.col("channel_type"))
    return joined.select(
        "transaction_sk",
        filters.pick(options, F.col("order_number")).alias("channel_sk"),
        F.concat_ws(",", options.cast("array<string>")).alias("admissible"),
    )


add(
    "case_source_system",
    lambda s: s.stores("store_sk", "is_digital").withColumn("source_system", filters.source_system(F.col("is_digital"))),
    "SELECT store_sk, is_digital, CASE WHEN is_digital THEN 'ECOM_PLATFORM' ELSE 'POS_SYSTEM' END AS source_system FROM c_stores",
)

NORTH, TOP = ("N01", "N02", "N03"), ("N01", "N07", "N12", "N18", "N24")
IN_NORTH = "country_code IN ('N01', 'N02', 'N03')"
IN_TOP = "country_code IN ('N01', 'N07', 'N12', 'N18', 'N24')"
add(
    "case_subregion_priority",
    lambda s: s.stores("store_sk", "country_code", "region_code").select(
        "store_sk",
        filters.sub_region(F.col("country_code"), F.col("region_code"), NORTH).alias("sub_region"),
        filters.country_tier(F.col("country_code"), TOP).alias("country_tier"),
        filters.city_tier(F.col("country_code"), TOP).alias("city_tier"),
    ),
    f"""SELECT store_sk, CASE WHEN {IN_NORTH} THEN 'NORTH_AMERICA' ELSE region_code END AS sub_region,
  CASE WHEN {IN_TOP} THEN 'TIER_1' ELSE 'TIER_2' END AS country_tier,
  CASE WHEN {IN_TOP} THEN 'TIER_2' ELSE 'TIER_3' END AS city_tier FROM c_stores""",
)


@query(
    "guest_sentinel",
    """SELECT transaction_sk, coalesce(l.customer_sk, 0) AS customer_sk,
  CASE WHEN coalesce(l.customer_sk, 0) = 0 THEN 'GUEST-ANONYMOUS' ELSE c.customer_nk END AS customer_nk
FROM c_lines l LEFT JOIN c_customers c ON c.customer_sk = l.customer_sk""",
)
def guest_sentinel(s: Star) -> DataFrame:
    """Key 0 is the guest; the test table's own customer 0 is left out."""
    known = s.customers().where("customer_sk <> 0")
    people = customers.with_guest(known, s.epoch).select("customer_sk", "customer_nk")
    sales = s.sales("transaction_sk", "customer_sk").withColumn("customer_sk", filters.guest_key(F.col("customer_sk")))
    return many_to_one(sales, people, "customer_sk", hot_keys=(0,)).select("transaction_sk", "customer_sk", "customer_nk")
