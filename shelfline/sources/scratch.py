"""Folders for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


_LOCAL_ROOT: list[str] = []


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder the session names for checkpoints.
    Only a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="shelfline-"))
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The frame as a table in a new folder, written now, so that what reads it several times computes it once. Partitions are
    written by few tasks each, so that the table has few files."""
    path = scratch_folder(df.sparkSession, purpose)
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
