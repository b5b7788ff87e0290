"""Queries over interval and error metrics (on the stand-in predictions table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.operators import metrics as M
from costlens.operators.features import one_hot
from costlens.operators.outliers import group_quantiles
from costlens.plans.materialise import broadcast_if_small
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures

DEC = 6
AFTER = "1996-01-01"
SPLIT_SQL = "CASE WHEN l_linenumber % 2 = 0 THEN 'train' ELSE 'test' END"


def rounded(df: DataFrame, decimals: int = DEC) -> DataFrame:
    """Round every double column (float sums differ by order between engines)."""
    return df.select(*[F.round(F.col(f.name), decimals).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _preds(spark, sf_dir):
    return fixture(spark, sf_dir, "preds")


def _r(expr, name, dec=DEC):
    return f"round({expr}, {dec}) AS {name}"


def _pin(y, p, a):
    return f"CASE WHEN {y} >= {p} THEN {a} * ({y} - {p}) ELSE {1 - a} * ({p} - {y}) END"


def _interval_sql(y="y", lo="lo", hi="hi"):
    return ", ".join([
        _r(f"avg({_pin(y, lo, 0.1)})", "pinball_lower"),
        _r(f"avg({_pin(y, hi, 0.9)})", "pinball_upper"),
        _r(f"avg(CASE WHEN {y} >= {lo} AND {y} <= {hi} THEN 1.0 ELSE 0.0 END)", "coverage"),
        _r(f"avg({hi} - {lo})", "width_mean"), _r(f"max({hi} - {lo})", "width_max"),
        _r(f"min({hi} - {lo})", "width_min"),
        _r(f"avg(abs({y} - {lo}))", "mae_lower"), _r(f"avg(abs({y} - {hi}))", "mae_upper"),
        "CAST(count(*) AS BIGINT) AS n"])


def _error_sql(y="y", p="y_pred", prefix=""):
    e = f"abs({y} - {p})"
    return ", ".join([
        _r(f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))", f"{prefix}r2"),
        _r(f"avg({e})", f"{prefix}mae"), _r(f"quantile_cont({e}, 0.5)", f"{prefix}mdae"),
        _r(f"avg(CASE WHEN {p} > {y} THEN 1.0 ELSE 0.0 END) * 100.0", f"{prefix}pct_over"),
        _r(f"avg(CASE WHEN {p} > {y} THEN {e} END)", f"{prefix}mae_over"),
        _r(f"quantile_cont(CASE WHEN {p} > {y} THEN {e} END, 0.5)", f"{prefix}mdae_over"),
        _r(f"avg(CASE WHEN {p} < {y} THEN 1.0 ELSE 0.0 END) * 100.0", f"{prefix}pct_under"),
        _r(f"avg(CASE WHEN {p} < {y} THEN {e} END)", f"{prefix}mae_under"),
        _r(f"quantile_cont(CASE WHEN {p} < {y} THEN {e} END, 0.5)", f"{prefix}mdae_under")])


@query("interval_metrics", with_fixtures(f"SELECT fold, {_interval_sql()} FROM preds GROUP BY fold", "preds"))
def q_interval_metrics(spark, sf_dir):
    """Pinball loss (0.1 / 0.9), coverage, width mean/max/min, MAE of each bound, per fold."""
    return rounded(M.interval_metrics(_preds(spark, sf_dir), "y", "lo", "hi", by=["fold"]))


@query("floor_metrics", with_fixtures(f"""
SELECT fold,
  {_r("avg(CASE WHEN lo < 8000 AND hi < 8000 THEN 1.0 ELSE 0.0 END) * 100.0", "pct_both_below")},
  {_r("avg(CASE WHEN lo < 8000 THEN 1.0 ELSE 0.0 END) * 100.0", "pct_lower_below")},
  {_r("avg(CASE WHEN lo < 8000 AND hi > 8000 THEN hi - 8000 END)", "lifted_width_mean")},
  {_r("min(hi - CASE WHEN lo < 8000 AND hi > 8000 THEN 8000 ELSE lo END)", "lifted_width_min")},
  {_r("max(hi - CASE WHEN lo < 8000 AND hi > 8000 THEN 8000 ELSE lo END)", "lifted_width_max")}
FROM preds GROUP BY fold
""", "preds"))
def q_floor_metrics(spark, sf_dir):
    """Floor statistics at 8,000 per fold (straddling intervals lifted to the floor)."""
    return rounded(M.floor_metrics(_preds(spark, sf_dir), "lo", "hi", 8000.0, by=["fold"]))


@query("floor_metrics_low", with_fixtures(f"""
WITH low AS (SELECT fold, lo, lo + 400 * (l_partkey % 4) AS hi FROM preds)
SELECT fold,
  {_r("avg(CASE WHEN lo < 8000 AND hi < 8000 THEN 1.0 ELSE 0.0 END) * 100.0", "pct_both_below")},
  {_r("avg(CASE WHEN lo < 8000 THEN 1.0 ELSE 0.0 END) * 100.0", "pct_lower_below")},
  {_r("avg(CASE WHEN lo < 8000 AND hi > 8000 THEN hi - 8000 END)", "lifted_width_mean")},
  {_r("min(hi - CASE WHEN lo < 8000 AND hi > 8000 THEN 8000 ELSE lo END)", "lifted_width_min")},
  {_r("max(hi - CASE WHEN lo < 8000 AND hi > 8000 THEN 8000 ELSE lo END)", "lifted_width_max")}
FROM low GROUP BY fold
""", "preds"))
def q_floor_metrics_low(spark, sf_dir):
    """Floor statistics of intervals around the floor: both bounds below it, upper bounds on it, and straddling."""
    low = _preds(spark, sf_dir).withColumn("hi", F.col("lo") + 400 * (F.col("l_partkey") % 4))
    return rounded(M.floor_metrics(low, "lo", "hi", 8000.0, by=["fold"]))


@query("error_metrics", with_fixtures(
    f"SELECT fold, {_error_sql()}, CAST(count(*) AS BIGINT) AS n FROM preds GROUP BY fold", "preds"))
def q_error_metrics(spark, sf_dir):
    """R2, MAE, median error, over/under shares and their errors, per fold."""
    return rounded(M.error_metrics(_preds(spark, sf_dir), "y", "y_pred", by=["fold"]))


@query("error_metrics_after", with_fixtures(f"""
WITH s AS (SELECT fold, {_r(f"avg(CASE WHEN d >= DATE '{AFTER}' THEN 1.0 ELSE 0.0 END)", "share_after")}
           FROM preds GROUP BY fold),
m AS (SELECT fold, {_error_sql()}, CAST(count(*) AS BIGINT) AS n FROM preds WHERE d >= DATE '{AFTER}' GROUP BY fold)
SELECT * FROM s LEFT JOIN m USING (fold)
""", "preds"))
def q_error_metrics_after(spark, sf_dir):
    """Error metrics over rows dated from 1996 on, and the share of such rows, per fold."""
    return rounded(M.error_metrics_after(_preds(spark, sf_dir), "y", "y_pred", "d", AFTER, by=["fold"]))


_GRP_LEVELS = ["A", "N", "R"]


@query("error_metrics_by_group", with_fixtures(f"""
SELECT feature, fold, {_error_sql()}, CAST(count(*) AS BIGINT) AS n
FROM (SELECT 'grp_' || grp AS feature, fold, y, y_pred FROM preds WHERE grp IN ('A', 'N', 'R')) t
GROUP BY feature, fold
""", "preds"))
def q_error_metrics_by_group(spark, sf_dir):
    """Error metrics per dummy feature and fold, from one unpivot + grouped aggregate."""
    df = one_hot(_preds(spark, sf_dir), {"grp": _GRP_LEVELS})
    dummies = [f"grp_{v}" for v in _GRP_LEVELS]
    return rounded(M.error_metrics_by_dummy(df, "y", "y_pred", dummies, by=["fold"]))


@query("fold_metrics", with_fixtures(f"""
WITH per AS (SELECT fold, {SPLIT_SQL} AS split, {_interval_sql().replace("round(", "(").replace(", 6)", ")")}
             FROM preds GROUP BY 1, 2)
SELECT split, {", ".join(_r(f"avg({m})", m) for m in
                         ["pinball_lower", "pinball_upper", "coverage", "width_mean"])}
FROM per GROUP BY split
""", "preds"))
def q_fold_metrics(spark, sf_dir):
    """Interval metrics per (fold, split), then the mean over folds per split."""
    df = _preds(spark, sf_dir).withColumn(
        "split", F.when(F.col("l_linenumber") % 2 == 0, "train").otherwise("test"))
    per = M.interval_metrics(df, "y", "lo", "hi", by=["fold", "split"])
    return rounded(M.mean_over(per, ["pinball_lower", "pinball_upper", "coverage", "width_mean"], by=["split"]))


@query("constant_baseline", with_fixtures(f"""
WITH per AS (SELECT fold, sum(y) AS s, count(y) AS n FROM preds GROUP BY fold),
tot AS (SELECT sum(y) AS s, count(y) AS n FROM preds)
SELECT per.fold, {_r("(tot.s - per.s) / (tot.n - per.n)", "train_mean")} FROM per, tot
""", "preds"))
def q_constant_baseline(spark, sf_dir):
    """Per fold the constant model: mean target of the other folds."""
    return rounded(M.constant_baseline(_preds(spark, sf_dir), "y", "fold"))


@query("compare_models", with_fixtures(f"""
WITH per AS (SELECT fold, sum(y) AS s, count(y) AS n FROM preds GROUP BY fold),
tot AS (SELECT sum(y) AS s, count(y) AS n FROM preds),
base AS (SELECT per.fold, (tot.s - per.s) / (tot.n - per.n) AS constant_pred FROM per, tot),
j AS (SELECT p.*, b.constant_pred FROM preds p JOIN base b USING (fold)),
f AS (SELECT fold, avg(abs(y - y_pred)) AS model_mae, avg(abs(y - constant_pred)) AS constant_mae,
        1 - sum((y - y_pred) * (y - y_pred)) / (var_pop(y) * count(y)) AS model_r2,
        1 - sum((y - constant_pred) * (y - constant_pred)) / (var_pop(y) * count(y)) AS constant_r2
      FROM j GROUP BY fold)
SELECT round(avg(model_mae), 2) + 0.0 AS model_mae, round(avg(constant_mae), 2) + 0.0 AS constant_mae,
       round(avg(model_r2), 2) + 0.0 AS model_r2, round(avg(constant_r2), 2) + 0.0 AS constant_r2 FROM f
""", "preds"))
def q_compare_models(spark, sf_dir):
    """Model vs constant (training-mean) baseline on test folds, mean over folds, 2 decimals."""
    df = M.with_constant_prediction(_preds(spark, sf_dir), "y", "fold")
    per = df.groupBy("fold").agg(
        F.avg(F.abs(F.col("y") - F.col("y_pred"))).alias("model_mae"),
        F.avg(F.abs(F.col("y") - F.col("constant_pred"))).alias("constant_mae"),
        M.r2("y", "y_pred").alias("model_r2"),
        M.r2("y", "constant_pred").alias("constant_r2"))
    return M.mean_over(per, ["model_mae", "constant_mae", "model_r2", "constant_r2"], decimals=2)


@query("interval_from_residuals", with_fixtures(f"""
WITH r AS (SELECT *, y - y_pred AS res FROM preds),
q AS (SELECT grp, quantile_cont(res, 0.1) AS q_lo, quantile_cont(res, 0.9) AS q_hi FROM r GROUP BY grp)
SELECT grp, {_r("q.q_lo", "q_lo")}, {_r("q.q_hi", "q_hi")},
  {_r("avg(CASE WHEN y >= y_pred + q_lo AND y <= y_pred + q_hi THEN 1.0 ELSE 0.0 END)", "coverage")}
FROM r JOIN q USING (grp) GROUP BY grp, q.q_lo, q.q_hi
""", "preds"))
def q_interval_from_residuals(spark, sf_dir):
    """Interval = point prediction + per-group residual quantiles (0.1, 0.9); coverage per group."""
    df = _preds(spark, sf_dir).withColumn("res", F.col("y") - F.col("y_pred"))
    q = group_quantiles(df, ["grp"], "res", (0.1, 0.9)).withColumnsRenamed({"q0": "q_lo", "q1": "q_hi"})
    j = df.join(broadcast_if_small(q), "grp").withColumn("lo_i", F.col("y_pred") + F.col("q_lo")) \
          .withColumn("hi_i", F.col("y_pred") + F.col("q_hi"))
    out = j.groupBy("grp", "q_lo", "q_hi").agg(
        F.avg(((F.col("y") >= F.col("lo_i")) & (F.col("y") <= F.col("hi_i"))).cast("double")).alias("coverage"))
    return rounded(out)
