"""Key, NULL and value checks; each returns a frame of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    fact: str
    fact_key: str
    dim: str
    dim_key: str


# The checked relationships of the star; the nullable ones are optional.
FOREIGN_KEYS = (
    ForeignKey("fact_sales_transactions", "transaction_date_sk", "dim_date", "date_sk"),
    ForeignKey("fact_sales_transactions", "product_sk", "dim_product", "product_sk"),
    ForeignKey("fact_sales_transactions", "store_sk", "dim_store", "store_sk"),
    ForeignKey("fact_sales_transactions", "channel_sk", "dim_channel", "channel_sk"),
    ForeignKey("fact_sales_transactions", "customer_sk", "dim_customer", "customer_sk"),
    ForeignKey("fact_sales_transactions", "employee_sk", "dim_employee", "employee_sk"),
    ForeignKey("fact_sales_transactions", "promotion_sk", "dim_promotion", "promotion_sk"),
    ForeignKey("fact_inventory_snapshot", "snapshot_date_sk", "dim_date", "date_sk"),
    ForeignKey("fact_inventory_snapshot", "product_sk", "dim_product", "product_sk"),
    ForeignKey("fact_inventory_snapshot", "store_sk", "dim_store", "store_sk"),
    ForeignKey("fact_returns", "return_date_sk", "dim_date", "date_sk"),
    ForeignKey("fact_returns", "product_sk", "dim_product", "product_sk"),
    ForeignKey("fact_returns", "store_sk", "dim_store", "store_sk"),
    ForeignKey("fact_returns", "channel_sk", "dim_channel", "channel_sk"),
    ForeignKey("fact_returns", "customer_sk", "dim_customer", "customer_sk"),
    ForeignKey("fact_web_sessions", "session_date_sk", "dim_date", "date_sk"),
    ForeignKey("fact_web_sessions", "channel_sk", "dim_channel", "channel_sk"),
    ForeignKey("fact_web_sessions", "customer_sk", "dim_customer", "customer_sk"),
)


def check_foreign_keys(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """Orphan keys per relationship whose tables are both given; NULL keys are fine.

    Each table is read once, however many relationships it takes part in: its
    keys are stacked as (relationship, key), and all tables meet in one
    aggregation, which brings each task's rows to different keys before its
    shuffle. Keys are integers."""
    present = [k for k in keys if k.fact in tables and k.dim in tables]
    spark = next(iter(tables.values())).sparkSession

    def stacked(table: str, named: list[tuple[int, str]], in_fact: bool) -> DataFrame:
        cells = [F.struct(F.lit(i).alias("_check"), F.col(c).cast("bigint").alias("_key")) for i, c in named]
        seen = tables[table].select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")
        side = seen.where(F.col("_key").isNotNull())
        return side.select("_check", "_key", F.lit(in_fact).alias("_used"), F.lit(not in_fact).alias("_known"))

    sides: dict[tuple[str, bool], list[tuple[int, str]]] = {}
    for i, k in enumerate(present):
        sides.setdefault((k.fact, True), []).append((i, k.fact_key))
        sides.setdefault((k.dim, False), []).append((i, k.dim_key))
    both = reduce(DataFrame.unionByName, [stacked(t, named, f) for (t, f), named in sides.items()])
    per_key = both.groupBy("_check", "_key").agg(F.bool_or("_used").alias("_used"), F.bool_or("_known").alias("_known"))
    counted = per_key.groupBy("_check").agg(F.count_if(F.col("_used") & ~F.col("_known")).alias("_orphans"))
    listed = spark.createDataFrame(
        [(i, k.fact, k.fact_key, k.dim, k.dim_key) for i, k in enumerate(present)],
        "_check INT, fact_table STRING, fk_column STRING, dim_table STRING, pk_column STRING",
    )
    orphan_keys = F.coalesce(F.col("_orphans"), F.lit(0))
    return listed.join(counted, "_check", "left").select(
        "fact_table", "fk_column", "dim_table", "pk_column",
        orphan_keys.alias("orphan_keys"), (orphan_keys == 0).alias("is_valid"),
    )


def check_primary_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str] | str]]) -> DataFrame:
    """Per table, given with its key: the number of key values that occur more than
    once, of rows beyond the first of each, and of rows with a NULL in the key.

    The keys of all tables are stacked and counted in one aggregation. A frame
    given under several names is read once for all its keys. A key of several
    columns is compared as their texts, each with its length."""

    def text(key: Sequence[str] | str) -> Column:
        texts = [F.col(c).cast("string") for c in ([key] if isinstance(key, str) else key)]
        parts = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
        return F.concat(*parts) if len(parts) > 1 else texts[0]

    def stacked(df: DataFrame, named: list[tuple[str, Sequence[str] | str]]) -> DataFrame:
        if len(named) == 1:
            name, key = named[0]
            return df.select(F.lit(name).alias("table_name"), text(key).alias("_key"))
        cells = [F.struct(F.lit(name).alias("table_name"), text(key).alias("_key")) for name, key in named]
        return df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")

    frames: dict[int, tuple[DataFrame, list[tuple[str, Sequence[str] | str]]]] = {}
    for name, (df, key) in tables.items():
        frames.setdefault(id(df), (df, []))[1].append((name, key))
    rows = reduce(DataFrame.unionByName, [stacked(df, named) for df, named in frames.values()])
    per_key = rows.groupBy("table_name", "_key").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = F.col("_key").isNotNull() & (F.col("_rows") > 1)
    found = per_key.groupBy("table_name").agg(
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_rows") - 1)), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("null_rows"),
    )
    return _for_each(found, list(tables), ("duplicate_keys", "surplus_rows", "null_rows"))


def _for_each(found: DataFrame, names: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """One row per table, also for those without rows."""
    listed = found.sparkSession.createDataFrame([(n,) for n in names], "table_name STRING")
    zeros = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts]
    return listed.join(found, "table_name", "left").select("table_name", *zeros)


def check_primary_key(df: DataFrame, table: str, key: Sequence[str] | str) -> DataFrame:
    """The same for one table."""
    return check_primary_keys({table: (df, key)})


def check_not_nulls(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with a NULL per required column of each table; a table's columns are counted in one pass."""

    def counted(name: str) -> DataFrame:
        required = list(columns[name])
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        return counts.unpivot([], required, "column_name", "null_rows").select(
            F.lit(name).alias("table_name"), "column_name", "null_rows"
        )

    return reduce(DataFrame.unionByName, [counted(name) for name in columns if columns[name]])


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """The same for one table."""
    return check_not_nulls({table: df}, {table: columns})


def check_all_allowed(tables: Mapping[str, DataFrame], allowed: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Values outside the declared sets with their row counts. The cells of all
    tables are stacked; only bad ones are shuffled, in one aggregation."""

    def bad(name: str) -> DataFrame:
        cells = [
            F.when(~F.col(c).isin(*values), F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("value")))
            for c, values in allowed[name].items()
        ]
        return tables[name].select(F.explode(F.filter(F.array(*cells), lambda cell: cell.isNotNull())).alias("_cell")).select("_cell.*")

    rows = reduce(DataFrame.unionByName, [bad(name) for name in allowed if allowed[name]])
    return rows.groupBy("table_name", "column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def check_allowed_values(df: DataFrame, table: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same for one table."""
    return check_all_allowed({table: df}, {table: allowed})


def check_conversions(sessions: DataFrame) -> DataFrame:
    """Sessions whose purchase flag disagrees with their linked transaction."""
    return sessions.where(F.col("purchase_completed_flag") != F.col("purchase_transaction_sk").isNotNull())
