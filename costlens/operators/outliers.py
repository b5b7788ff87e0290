"""Per-group IQR outlier treatment and group ranking.

Group statistics are one aggregate (combined map-side) producing one row
per group; that small table is joined back, and adaptive execution turns
the join into a broadcast once the materialised side is measured small.
No window over the group: a group holding a third of all rows never lands
whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens import config as C
from costlens.operators.quantiles import exact_quantiles
from costlens.operators.ranking import exact_rank
from costlens.plans.materialise import broadcast_if_small, dealt

WINSORISE_MODES = ("none", "upper", "lower", "both")


def group_quantiles(df: DataFrame, groups: Sequence[str], target: str,
                    probs: Sequence[float] = (0.25, 0.75)) -> DataFrame:
    """Per group the ``probs`` quantiles of ``target`` as columns ``q0, q1, ...``.

    Exact, with linear interpolation between order statistics (like pandas
    and DuckDB ``quantile_cont``), whatever the size of a group.
    """
    return exact_quantiles(df, groups, target, probs)


def iqr_bounds(df: DataFrame, groups: Sequence[str], target: str, k: float = C.IQR_MULTIPLIER,
               probs: Sequence[float] = (0.25, 0.75)) -> DataFrame:
    """Per group ``lower_bound = Q1 - k*IQR`` and ``upper_bound = Q3 + k*IQR``."""
    q = group_quantiles(df, groups, target, probs)
    iqr = F.col("q1") - F.col("q0")
    return q.select(*groups, F.col("q0").alias("q_low"), F.col("q1").alias("q_high"),
                    (F.col("q0") - F.lit(k) * iqr).alias("lower_bound"),
                    (F.col("q1") + F.lit(k) * iqr).alias("upper_bound"))


def treat_outliers(df: DataFrame, groups: Sequence[str], target: str, mode: str = C.WINSORISE_MODE,
                   k: float = C.IQR_MULTIPLIER, probs: Sequence[float] = (0.25, 0.75),
                   keep_bounds: bool = False,
                   prepare_bounds=broadcast_if_small) -> DataFrame:
    """Remove or cap ``target`` outside the per-group IQR fences (inclusive).

    Rows with a null group key are dropped in every mode. Modes: ``none``
    drops both tails; ``upper`` caps high values and drops low ones;
    ``lower`` caps low values and drops high ones; ``both`` caps both tails;
    any other text leaves the rows unchanged. ``prepare_bounds`` wraps the
    one-row-per-group statistics before the join: a size-checked broadcast,
    so that a large group is not shuffled to one task (None: the planner's
    join). The rows are read three times; pass a written table.
    """
    df = df.na.drop(how="any", subset=list(groups))
    bounds = iqr_bounds(df, groups, target, k, probs)
    if prepare_bounds is not None:
        bounds = prepare_bounds(bounds)
    j = df.join(bounds, on=list(groups), how="inner")
    t, lo, hi = F.col(target), F.col("lower_bound"), F.col("upper_bound")
    if mode == "none":
        j = j.filter((t >= lo) & (t <= hi))
    elif mode == "both":
        j = j.withColumn(target, F.when(t > hi, hi).when(t < lo, lo).otherwise(t))
    elif mode == "upper":
        j = j.filter(t >= lo).withColumn(target, F.when(t > hi, hi).otherwise(t))
    elif mode == "lower":
        j = j.withColumn(target, F.when(t < lo, lo).otherwise(t)).filter(F.col(target) <= hi)
    if keep_bounds:
        return j
    return j.select(*df.columns)


def group_distinct_rank(df: DataFrame, groups: Sequence[str], key: str,
                        label_prefix: str = "combination_") -> DataFrame:
    """Distinct ``key`` count per group, numbered 1..G by (count, group values)
    ascending, with a text label ``{prefix}{n}``.

    The rows are dealt by (group, key) to tasks by their number, and the
    groups are numbered by ranges (see ``exact_rank``), so no task holds more
    pairs or groups as the input grows.
    """
    names = list(dict.fromkeys([*groups, key]))
    rows = dealt(df.na.drop(how="any", subset=list(groups)).select(*names), *names)
    pairs = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    counts = pairs.groupBy(*groups).agg(F.count(key).cast("bigint").alias("n_distinct"))
    ranked = exact_rank(counts, ["n_distinct", *groups], out="group_rank").withColumn("group_rank", F.col("group_rank") + 1)
    return ranked.withColumn("group_label", F.concat(F.lit(label_prefix), F.col("group_rank").cast("string")))
