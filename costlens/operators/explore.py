"""Exploration aggregates: the numbers behind the source's tables and figures.

All are grouped aggregates (map-side combined). Histograms emit every bin,
including empty ones, by left-joining counts to a generated bin table whose
size is the bin count (a parameter, not data).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.functions.expressions import col
from costlens.operators.quantiles import exact_quantiles, ranked_quantiles
from costlens.plans.materialise import broadcast_if_small


def yearly_stats(df: DataFrame, date: str, value: str, key: str) -> DataFrame:
    """Mean of ``value`` and count of ``key`` per calendar year of ``date``."""
    return (df.filter(F.col(date).isNotNull())
              .groupBy(F.year(date).cast("bigint").alias("year"))
              .agg(F.avg(value).alias(f"mean_{value}"), F.count(key).cast("bigint").alias("n")))


def binned_mean(df: DataFrame, bin_expr: Column, value: str, bin_name: str = "bin") -> DataFrame:
    """Mean of ``value`` per bin (bins from e.g. ``bin_up``; null bin dropped)."""
    return (df.withColumn(bin_name, bin_expr).filter(F.col(bin_name).isNotNull())
              .groupBy(bin_name).agg(F.avg(value).alias(f"mean_{value}"), F.count(F.lit(1)).cast("bigint").alias("n")))


def column_totals(df: DataFrame, columns: Sequence[str], name: str = "feature") -> DataFrame:
    """Sum of each column as rows (feature, total), largest first."""
    sums = df.agg(*[F.sum(c).cast("bigint").alias(c) for c in columns])
    return sums.unpivot([], list(columns), name, "total").orderBy(F.desc("total"), name)


def gap_stats(df: DataFrame, later: str, earlier: str) -> DataFrame:
    """Median, mean and max of the day gap ``later - earlier``."""
    gap = F.datediff(F.col(later).cast("date"), F.col(earlier).cast("date")).cast("double")
    rest = df.agg(F.avg(gap).alias("mean_days"), F.max(gap).alias("max_days"))
    return exact_quantiles(df, [], gap, [0.5]).crossJoin(F.broadcast(rest)).withColumnRenamed("q0", "median_days")


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column with ``target`` as rows, highest first."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "correlation").orderBy(F.desc("correlation"))


def bin_table(spark: SparkSession, lo: float, width: float, n_bins: int) -> DataFrame:
    return spark.range(n_bins).select(F.col("id").cast("bigint").alias("bin"),
                                      (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_lower"))


def histogram_fixed(df: DataFrame, value: str, lo: float, hi: float, width: float,
                    subset: Column | None = None) -> DataFrame:
    """Fixed-width histogram on [lo, hi] (last bin closed), counts and densities
    (count / (in-range count x width)); optionally also for a subset of rows."""
    n_bins = int(round((hi - lo) / width))
    v = F.col(value)
    in_range = (v >= lo) & (v <= hi)
    idx = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("bigint")
    flag = subset if subset is not None else F.lit(False)
    counts = (df.filter(in_range).select(idx.alias("bin"), flag.alias("_sub"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_sub")).alias("n_subset")))
    totals = counts.agg(F.sum("n").alias("_tn"), F.sum("n_subset").alias("_ts"))
    out = (bin_table(df.sparkSession, lo, width, n_bins).join(counts, "bin", "left")
           .crossJoin(F.broadcast(totals))
           .select("bin", "bin_lower", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                   F.try_divide(F.coalesce("n", F.lit(0)), F.col("_tn") * F.lit(width)).alias("density"),
                   F.coalesce("n_subset", F.lit(0)).cast("bigint").alias("n_subset"),
                   F.try_divide(F.coalesce("n_subset", F.lit(0)), F.col("_ts") * F.lit(width)).alias("density_subset")))
    return out if subset is not None else out.drop("n_subset", "density_subset")


def histogram_range(df: DataFrame, value: str, n_bins: int = 30) -> DataFrame:
    """``n_bins`` equal bins from min to max of ``value`` (last bin closed)."""
    rng = df.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    v = F.col(value)
    width = (F.col("_mx") - F.col("_mn")) / F.lit(n_bins)
    idx = F.least(F.floor((v - F.col("_mn")) * F.lit(n_bins) / (F.col("_mx") - F.col("_mn"))),
                  F.lit(n_bins - 1)).cast("bigint")
    counts = (df.filter(v.isNotNull()).crossJoin(F.broadcast(rng)).select(idx.alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    bins = df.sparkSession.range(n_bins).select(F.col("id").cast("bigint").alias("bin"))
    return (bins.crossJoin(F.broadcast(rng)).join(counts, "bin", "left")
                .select("bin", (F.col("_mn") + F.col("bin") * width).alias("bin_lower"),
                        F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def median_by_flag(df: DataFrame, value: str, flags: Sequence[str]) -> DataFrame:
    """Median of ``value`` for rows of each 0/1 flag, next to the overall median."""
    long = df.unpivot([value], list(flags), "feature", "_f").filter(F.col("_f") == 1)
    per = exact_quantiles(long, ["feature"], value, [0.5]).withColumnRenamed("q0", f"median_{value}")
    overall = exact_quantiles(df, [], value, [0.5]).withColumnRenamed("q0", f"overall_median_{value}")
    return per.crossJoin(F.broadcast(overall))


def percentile_bounds(df: DataFrame, columns: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Low and high percentiles (linear interpolation, nulls ignored) per column, as rows."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "_v")
    return exact_quantiles(long, ["feature"], "_v", [lo, hi]).withColumnsRenamed({"q0": "p_low", "q1": "p_high"})


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Row count per value (nulls dropped), most frequent first."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).cast("bigint").alias("n")).orderBy(F.desc("n"), column))


def residual_trend(df: DataFrame, residual: str, columns: Sequence[str]) -> DataFrame:
    """Least-squares trend line of the residual against each column (slope, intercept)."""
    long = df.unpivot([residual], list(columns), "feature", "_x")
    return long.groupBy("feature").agg(
        F.regr_slope(F.col(residual), F.col("_x").cast("double")).alias("slope"),
        F.regr_intercept(F.col(residual), F.col("_x").cast("double")).alias("intercept"),
        F.regr_count(F.col(residual), F.col("_x").cast("double")).cast("bigint").alias("n"))


def box_stats(df: DataFrame, value: str, by: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (furthest points within
    k x IQR of the box) and outlier count. Quartiles are a small per-group table
    joined back (broadcast if small), then one more grouped aggregate."""
    q = broadcast_if_small(exact_quantiles(df, by, value, [0.25, 0.5, 0.75]).toDF(*by, "q1", "median", "q3"))
    v = F.col(value)
    j = df.join(q, on=list(by), how="inner")
    lo = F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_low"),
        F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.count_if((v < lo) | (v > hi)).cast("bigint").alias("n_outliers"))


def normal_grid(probs: Sequence[float]) -> list[tuple[float, float]]:
    """(p, standard-normal quantile of p) pairs: a small literal table."""
    nd = NormalDist()
    return [(float(p), nd.inv_cdf(p)) for p in probs]


def qq_points(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """Sample quantiles of ``value`` on a probability grid against normal quantiles.

    The sample side is the exact quantiles at the grid, each found in the range of values that holds it; the
    theoretical side is a literal table of len(probs) rows. Without values the sample side is null.
    """
    grid = normal_grid(probs)
    names = "i int, p double, theoretical double"
    theory = df.sparkSession.createDataFrame([(i, float(p), float(z)) for i, (p, z) in enumerate(grid)], names)
    sample = ranked_quantiles(df, [], value, [p for p, _ in grid])  # one row a probability
    return theory.join(F.broadcast(sample), "i", "left").select("p", "theoretical", F.col("q").alias("sample"))
