"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table,
``(offset + j * skip) mod size``; shards take turns claiming their next free
preferred slot until the table is full. A row goes to the shard of the slot
that its key hashes to. Shards get equal shares to within one slot, and a
shard that comes or goes moves few keys.

The main path is DataFrame functions only: one hash per row and a join with
the broadcast table, whose row count is the ``size`` parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Prime; about 100 slots or more for each of up to 650 shards.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(shard: str, size: int) -> tuple[int, int]:
    """Start and step of a shard's order over the slots; any step below a prime ``size`` visits every slot."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard number of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("size must be a prime of at least the number of shards")
    # In the order of the names, so that the table does not depend on the order of the list.
    turn = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: preference(shards[i], size) for i in turn}
    slots, free = [-1] * size, size
    while free:
        for i in turn:
            if not free:
                break
            slot, skip = at[i]
            while slots[slot] >= 0:
                slot = (slot + skip) % size
            slots[slot], free = i, free - 1
            at[i] = ((slot + skip) % size, skip)
    return slots


def slot_table(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """The filled table as rows (slot, shard, shard_name); ``size`` rows."""
    filled = F.split(F.lit(",".join(map(str, fill_table(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    rows = spark.range(1).select(F.posexplode(filled).alias("slot", "s"))
    return rows.select("slot", F.col("s").cast("int").alias("shard")).withColumn(
        "shard_name", F.element_at(names, F.col("shard") + 1))


def slot_of(key: Sequence[str], spread: Sequence[str] = (), size: int = TABLE_SIZE) -> Column:
    """Slot of a row's key. Rows whose key columns are all null are dealt by the ``spread`` columns instead."""
    by_key = F.xxhash64(*[F.col(c).cast("string") for c in key])
    if spread:
        none = F.coalesce(*[F.col(c).cast("string") for c in key]).isNull()
        by_key = F.when(none, F.xxhash64(*[F.col(c).cast("string") for c in spread])).otherwise(by_key)
    return F.pmod(by_key, F.lit(size)).cast("int")


def assign_shards(df: DataFrame, key: Sequence[str], shards: Sequence[str], size: int = TABLE_SIZE,
                  spread: Sequence[str] = ()) -> DataFrame:
    """Add slot, shard (number) and shard_name to every row; columns of those names are replaced.

    Equal keys get equal shards, so repeated rows stay together; a null key
    counts as one key unless ``spread`` names columns to deal such rows by.
    An empty table stays empty. Shard names hold no line breaks.
    """
    base = df.drop("slot", "shard", "shard_name").withColumn("slot", slot_of(key, spread, size))
    return base.join(F.broadcast(slot_table(df.sparkSession, shards, size)), "slot")
