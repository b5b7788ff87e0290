"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Largest side (rows) that an operator broadcasts after counting it; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send texts to Python in batches of ``rows`` unless the session has a batch size of its own.

    Spark's default of 10,000 rows holds some 100 MB of long texts on both
    sides of the pipe, for every task at once.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read through Spark (so any store that Spark reads will do)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case. Text that is all ASCII takes the quicker built-in."""
    return F.when(col.rlike("[^\\x00-\\x7F]"), F.translate(col, UPPER, UPPER.lower())).otherwise(F.lower(col))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: later steps (and tasks retried after a lost executor)
    read the files instead of computing the rows again, and Spark knows the
    table's size.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_small(stashed: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stashed table for broadcast if a count shows at most ``max_rows`` narrow rows, else leave it."""
    return F.broadcast(stashed) if stashed.limit(max_rows + 1).count() <= max_rows else stashed


def filter_by_text(df: DataFrame, text_col: str, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """The rows of ``df``, every column as it was, for whose texts ``keep`` (over a batch) is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(np.asarray(keep(b.column(text_col).to_pylist()), dtype=bool)))

    return df.mapInArrow(run, df.schema)
