"""Creating, filling and dropping tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import TABLES, TableSpec

# Tables of a star that are written at the same time.
WRITES_AT_ONCE = 4


def create_table(spark: SparkSession, spec: TableSpec, table: str, location: str) -> None:
    """Create an empty parquet table with the declared types, defaults and partitions."""
    columns = []
    for f in spec.schema.fields:
        required = "" if f.nullable else " NOT NULL"
        default = f" DEFAULT {spec.defaults[f.name]}" if f.name in spec.defaults else ""
        columns.append(f"{f.name} {f.dataType.simpleString()}{required}{default}")
    layout = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet{layout} LOCATION '{location}'")


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def conform(df: DataFrame, spec: TableSpec, given: Mapping[str, Column] | None = None) -> DataFrame:
    """The declared columns in declared order and type. Columns the frame lacks,
    and NULLs, get the declared default where there is one. ``given`` has values
    that a job sets itself, such as the time of the load, the same for all rows."""
    given = given or {}
    out = []
    for f in spec.schema.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in given:
            value = F.coalesce(value.cast(f.dataType), given[f.name])
        elif f.name in spec.defaults:
            value = F.coalesce(value, F.expr(spec.defaults[f.name]))
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def apply_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Fill NULLs by SQL default expressions, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.expr(d).cast(types[c])) for c, d in defaults.items()})


def balanced(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Group rows by partition value for writing; a heavy value is split over
    several tasks and files, light ones share a task."""
    names = list(partition_by)
    return df.hint("rebalance", *names) if names else df.hint("rebalance")


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace the table's rows. Columns are matched by position, so they are
    first put into table order by name."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.mode("overwrite").insertInto(table)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    names = list(partition_by)
    writer = balanced(df, names).write.mode("overwrite")
    (writer.partitionBy(*names) if names else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV part files."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_star(tables: Mapping[str, DataFrame], root: str) -> None:
    """Every table to its own parquet directory, laid out as declared. Some are written at once, so that the last tasks and the
    commit of one, with its many partitions, do not leave the cluster idle."""

    def write(name: str) -> None:
        write_parquet(tables[name], f"{root}/{name}", TABLES[name].partition_by)

    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        list(pool.map(write, tables))


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
