"""Stable fold and train/test assignment by key hash.

The fold of a row depends only on its key and the seed (first 32 bits of
``md5(seed|key)``), so it is the same for any partitioning, any executor
count and any rerun, and it needs no shuffle or global sort. Fold sizes are
equal in expectation; ``assign_equal_folds`` makes them equal at the cost of
one shuffle by ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.operators.ranking import exact_rank, free_names


def key_hash(key: str, seed: int) -> Column:
    """Non-negative 32-bit integer from md5 of ``seed|key``."""
    text = F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, (key_hash(key, seed) % F.lit(k)).cast("int"))


def assign_equal_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds whose sizes differ by one at most: rows ordered by the hash of their key are dealt in turn.

    Rows of one key follow each other, so they get different folds; null keys
    come first. ``df`` must read alike twice (see ``exact_rank``).
    """
    h, place = free_names([*df.columns, out], "_h", "_place")
    ranked = exact_rank(df.withColumn(h, key_hash(key, seed)), [h, key], out=place)
    return ranked.withColumn(out, (F.col(place) % F.lit(k)).cast("int")).drop(h, place)


def train_test_flag(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42,
                    out: str = "is_test") -> DataFrame:
    """``is_test`` for about ``test_pct`` percent of keys."""
    return df.withColumn(out, (key_hash(key, seed) % F.lit(100)) < F.lit(test_pct))


def fold_split(df: DataFrame, fold_col: str, test_fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) for one fold: test = rows of ``test_fold``."""
    is_test = F.col(fold_col) == F.lit(test_fold)
    return df.filter(~is_test), df.filter(is_test)
