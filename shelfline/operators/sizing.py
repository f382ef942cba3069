"""When a join side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Memory that the rows of one broadcast may take. The driver builds it and holds it twice, several of them at the same time.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# A row of a table with a key takes at least so many bytes of its files, however well the other columns compress.
ROW_FILE_BYTES = 4
# What a row takes in a broadcast besides the values of its columns.
ROW_MEMORY_BYTES = 48


def input_bytes(df: DataFrame) -> int | None:
    """An upper bound of the frame's size: the optimizer's estimate for the frame itself, in which columns that it leaves out
    do not count, or the sum of all that it reads if that is less, as for joins. None when unknown."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        return min(_read_bytes(plan), int(str(plan.stats().sizeInBytes())))
    except AttributeError:  # a remote session has no JVM handle
        return None


def _read_bytes(plan) -> int:
    leaves = plan.collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def memory_bytes(df: DataFrame) -> int | None:
    """An upper bound of what the frame's rows take in a broadcast. Files say little of it, since columns shrink in them by any
    factor and those that the frame leaves out count or do not; rows are bounded by the bytes of all that is read. Only for
    frames with at most one row per input row. None when unknown."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        rows, known = -(-_read_bytes(plan) // ROW_FILE_BYTES), plan.stats().rowCount()
        if known.isDefined():
            rows = min(rows, int(str(known.get())))
        return rows * (ROW_MEMORY_BYTES + df._jdf.schema().defaultSize())
    except AttributeError:  # a remote session has no JVM handle
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its rows fit the limit. Otherwise leave
    the choice to the optimizer and to adaptive execution. Only for frames with
    at most one row per input row."""
    return F.broadcast(df) if is_small(df, limit) else df


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    size = memory_bytes(df)
    return size is not None and size <= limit
