"""The load job: CSV files into existing tables, with a count of what arrived."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.readers import read_csv_like
from shelfline.sources.writers import balanced, insert_overwrite


def load_csv_tables(
    spark: SparkSession, files: Mapping[str, str], partition_by: Mapping[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Replace each table's rows with those of its CSV folder, and report the rows that were written.

    The loop is over tables; the rows of each are read and written by the executors. Rows are counted in the tasks that write
    them, so nothing is read again for the report, which has one row per table."""
    layout = partition_by or {}
    written = []
    for table, path in files.items():
        seen = Observation()
        rows = balanced(read_csv_like(spark, path, table), layout.get(table, ()))
        insert_overwrite(rows.observe(seen, F.count(F.lit(1)).alias("cnt")), table)
        written.append((table, seen.get["cnt"]))
    return spark.createDataFrame(written, "table_name STRING, cnt BIGINT")
