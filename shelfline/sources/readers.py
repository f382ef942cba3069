"""Scans with declared schemas, views, and load reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import TABLES


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a declared schema; nothing is inferred. A header that
    does not list the schema's columns in order is an error, not a silent shift."""
    reader = spark.read.format("csv").option("header", "true").option("enforceSchema", "false")
    return reader.schema(schema).load(path)


def read_csv_like(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Headered CSV with the column types of a catalog table, in the file's column
    order: a partitioned table lists its partition columns last, a file may not."""
    known = {f.name: f for f in spark.table(table).schema.fields}
    header = spark.read.option("header", "true").csv(path).columns
    return read_csv(spark, path, T.StructType([known[c] for c in header]))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_star_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the twelve tables from its parquet directory under ``root``."""
    return read_parquet(spark, f"{root}/{name}", TABLES[name].schema)


def staging_view(df: DataFrame, name: str) -> DataFrame:
    """Give a frame a name for SQL. Nothing is stored; the plan is inlined."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, in one result."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    width = {n: len(df.columns) for n, df in tables.items()}
    columns = F.element_at(F.create_map(*[F.lit(x) for p in width.items() for x in p]), F.col("table_name"))
    return row_counts(tables).withColumn("column_count", columns)
