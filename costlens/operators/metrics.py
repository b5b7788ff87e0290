"""Interval and error metrics as grouped aggregates (one pass each).

Every metric is an aggregate expression, so a metric over any grouping
(fold, split, feature) is one ``groupBy`` with map-side combine. Medians are
exact (see ``quantiles``). Metrics over an empty subset are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions.expressions import col, pinball
from costlens.operators.quantiles import exact_quantiles, same_groups


def _agg(df: DataFrame, by: Sequence[str], aggs: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def interval_metric_columns(y, lo, hi, alpha_lo: float = C.INTERVAL_QUANTILES[0],
                            alpha_hi: float = C.INTERVAL_QUANTILES[1]) -> list[Column]:
    y, lo, hi = col(y), col(lo), col(hi)
    width = hi - lo
    return [
        F.avg(pinball(y, lo, alpha_lo)).alias("pinball_lower"),
        F.avg(pinball(y, hi, alpha_hi)).alias("pinball_upper"),
        F.avg(((y >= lo) & (y <= hi)).cast("double")).alias("coverage"),
        F.avg(width).alias("width_mean"),
        F.max(width).alias("width_max"),
        F.min(width).alias("width_min"),
        F.avg(F.abs(y - lo)).alias("mae_lower"),
        F.avg(F.abs(y - hi)).alias("mae_upper"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    ]


def interval_metrics(df: DataFrame, y: str, lo: str, hi: str, by: Sequence[str] = (),
                     alpha_lo: float = C.INTERVAL_QUANTILES[0],
                     alpha_hi: float = C.INTERVAL_QUANTILES[1]) -> DataFrame:
    """Pinball loss of each bound, coverage (inclusive), width mean/max/min, MAE of each bound."""
    return _agg(df, by, interval_metric_columns(y, lo, hi, alpha_lo, alpha_hi))


def floor_metrics(df: DataFrame, lo: str, hi: str, floor: float = C.FLOOR_PRICE,
                  by: Sequence[str] = ()) -> DataFrame:
    """Floor statistics: % both bounds below the floor, % lower below, and the
    width after lifting the lower bound to the floor on straddling intervals
    (lower < floor < upper): mean over those rows, min and max over all rows."""
    lo_c, hi_c, fl = col(lo), col(hi), F.lit(float(floor))
    straddle = (lo_c < fl) & (hi_c > fl)
    lifted = hi_c - F.when(straddle, fl).otherwise(lo_c)
    return _agg(df, by, [
        (F.avg(((lo_c < fl) & (hi_c < fl)).cast("double")) * 100.0).alias("pct_both_below"),
        (F.avg((lo_c < fl).cast("double")) * 100.0).alias("pct_lower_below"),
        F.avg(F.when(straddle, lifted)).alias("lifted_width_mean"),
        F.min(lifted).alias("lifted_width_min"),
        F.max(lifted).alias("lifted_width_max"),
    ])


def r2(y, p) -> Column:
    """1 - residual sum of squares / total sum of squares, as an aggregate."""
    y, p = col(y), col(p)
    return F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))


def error_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, median absolute error, over/under-prediction shares (%), and
    MAE / median error within over- and under-predictions (strict)."""
    y, p = col(y), col(p)
    err = F.abs(y - p)
    over, under = p > y, p < y
    means = _agg(df, by, [
        r2(y, p).alias("r2"),
        F.avg(err).alias("mae"),
        (F.avg(over.cast("double")) * 100.0).alias("pct_over"),
        F.avg(F.when(over, err)).alias("mae_over"),
        (F.avg(under.cast("double")) * 100.0).alias("pct_under"),
        F.avg(F.when(under, err)).alias("mae_under"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    ])
    # The three medians as one: every row stands among all errors and among those of its side.
    side = F.when(over, "mdae_over").when(under, "mdae_under")
    long = df.select(*by, err.alias("_err"), F.explode(F.array(F.lit("mdae"), side)).alias("_kind")).where("_kind is not null")
    medians = exact_quantiles(long, [*by, "_kind"], "_err", [0.5])
    medians = _agg(medians, by, [F.max(F.when(F.col("_kind") == k, F.col("q0"))).alias(k)
                                 for k in ("mdae", "mdae_over", "mdae_under")])
    return same_groups(means, medians, by, "left").select(
        *by, "r2", "mae", "mdae", "pct_over", "mae_over", "mdae_over", "pct_under", "mae_under", "mdae_under", "n")


def error_metrics_after(df: DataFrame, y: str, p: str, date: str, after: str,
                        by: Sequence[str] = ()) -> DataFrame:
    """Error metrics over rows dated on/after ``after`` plus the share of such rows."""
    is_after = F.coalesce(col(date) >= F.to_date(F.lit(after)), F.lit(False))
    share = _agg(df, by, [F.avg(is_after.cast("double")).alias("share_after")])
    m = error_metrics(df.filter(is_after), y, p, by)
    if not by:
        return share.crossJoin(m)
    return share.join(m, on=list(by), how="left")


def unpivot_dummies(df: DataFrame, dummies: Sequence[str], keep: Sequence[str],
                    name: str = "feature") -> DataFrame:
    """One row per (row, dummy) where the dummy is 1 (long form, no loop over features)."""
    long = df.unpivot(list(keep), list(dummies), name, "_flag")
    return long.filter(F.col("_flag") == 1).drop("_flag")


def error_metrics_by_dummy(df: DataFrame, y: str, p: str, dummies: Sequence[str],
                           by: Sequence[str] = ()) -> DataFrame:
    """Error metrics for the rows of each dummy feature, in one grouped aggregate."""
    long = unpivot_dummies(df, dummies, [y, p, *by])
    return error_metrics(long, y, p, ["feature", *by])


def mean_over(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), decimals: int | None = None):
    """Mean of per-fold metrics (optionally rounded)."""
    aggs = [F.avg(m).alias(m) for m in metrics]
    if decimals is not None:
        aggs = [F.round(F.avg(m), decimals).alias(m) for m in metrics]
    return _agg(df, by, aggs)


def constant_baseline(df: DataFrame, y: str, fold: str) -> DataFrame:
    """Per fold the training mean (mean of ``y`` outside the fold).

    From per-fold sums and counts (one aggregate), never a pass per fold.
    """
    per = df.groupBy(fold).agg(F.sum(col(y)).alias("_fold_sum"), F.count(col(y)).alias("_fold_n"))
    tot = df.agg(F.sum(col(y)).alias("_all_sum"), F.count(col(y)).alias("_all_n"))
    return (per.crossJoin(F.broadcast(tot))
               .select(fold, F.try_divide(F.col("_all_sum") - F.col("_fold_sum"),
                                          F.col("_all_n") - F.col("_fold_n")).alias("train_mean")))


def with_constant_prediction(df: DataFrame, y: str, fold: str, out: str = "constant_pred") -> DataFrame:
    """Test rows (fold k) get the fold's training mean as prediction.

    The per-fold table has one row per fold (k rows), so it is broadcast.
    """
    base = constant_baseline(df, y, fold).withColumnRenamed("train_mean", out)
    return df.join(F.broadcast(base), on=fold, how="left")
