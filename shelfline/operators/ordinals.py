"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# Keys are hashed to 60 bits; 2**48 keys per slice make 4,096 slices per group.
SLICE_BITS = 48


def ordinal_within(
    df: DataFrame, groups: Sequence[str], key: str, alias: str = "ordinal", slice_bits: int = SLICE_BITS
) -> DataFrame:
    """Number the rows of each group from 1 in the order of an integer key.

    A group may hold a large part of all rows, so it is cut into slices of the
    key range. Rows are numbered inside a slice, and each slice adds the row
    count of the slices before it. The counts are a small table: one row per
    group and slice.
    """
    names = list(groups)
    sliced = df.withColumn("_slice", F.shiftright(F.col(key), slice_bits))
    before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*names, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *[F.col(n).alias(f"_g_{n}") for n in names],
            F.col("_slice").alias("_g_slice"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = Window.partitionBy(*names, "_slice").orderBy(key)
    same = F.col("_slice") == F.col("_g_slice")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_g_{n}"))
    return (
        sliced.withColumn("_in_slice", F.row_number().over(inside))
        .join(starts, same, "left")
        .withColumn(alias, (F.col("_start") + F.col("_in_slice")).cast("bigint"))
        .drop("_slice", "_in_slice", "_start", "_g_slice", *[f"_g_{n}" for n in names])
    )
