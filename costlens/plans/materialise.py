"""Lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import gc
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.session import checkpoint_dir

# Largest small side (rows) that is broadcast; bigger sides use a shuffle join.
BROADCAST_MAX_ROWS = 200_000
# Rows that a task takes of a table dealt by key.
DEALT_ROWS = 500_000


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows once as Parquet in the shared checkpoint folder and read them back.

    Later scans read only the columns they use, the planner knows the
    table's size, and tasks lost with an executor re-read the files instead
    of computing the rows again. The rows' partitioning is not kept: a later
    step by key shuffles once more.
    """
    return materialised(df)[0]


def materialised(df: DataFrame) -> tuple[DataFrame, str]:
    """``materialise`` and the folder of the files, for a caller that deletes them with ``discard``."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete the files of a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage: the shuffle files of steps that nothing refers to any more are deleted only then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       materialised: bool = False) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; otherwise
    return it unchanged so the planner uses a shuffle join.

    The table is materialised first (unless the caller already did), so the
    size check and the join read the same computed rows.
    """
    small = df if materialised else materialise(df)
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def dealt(df: DataFrame, *keys: str, rows_a_task: int = DEALT_ROWS) -> DataFrame:
    """The rows, written once and dealt by the hash of ``keys`` to as many tasks as their number asks for.

    A grouping by these keys (or more) needs no other shuffle, and the groups
    that a task holds do not grow with the table: the number of tasks does.
    """
    rows = materialise(df)
    return rows.repartition(max(1, math.ceil(rows.count() / rows_a_task)), *keys)
