"""Queries over exploration aggregates and fold assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.functions.expressions import bin_up, days_since
from costlens.operators import explore as X
from costlens.operators.features import one_hot
from costlens.operators.quantiles import weighted_quantiles
from costlens.operators.split import assign_equal_folds, assign_folds, train_test_flag
from costlens.plans.materialise import materialise
from costlens.plans.metric_queries import rounded
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures

DAYS_FROM = "1992-01-01"
QQ_PROBS = [round(0.01 * i, 2) for i in range(1, 100)]


def _inst(spark, sf_dir):
    return fixture(spark, sf_dir, "inst")


def _resid(spark, sf_dir):
    return fixture(spark, sf_dir, "preds").withColumn("res", F.col("y") - F.col("y_pred"))


@query("yearly_stats", with_fixtures("""
SELECT CAST(year(event_date) AS BIGINT) AS year, round(avg(cost), 4) AS mean_cost, CAST(count(unit_id) AS BIGINT) AS n
FROM inst WHERE event_date IS NOT NULL GROUP BY 1
""", "inst"))
def q_yearly_stats(spark, sf_dir):
    """Mean cost and record count per installation year."""
    return rounded(X.yearly_stats(_inst(spark, sf_dir), "event_date", "cost", "unit_id"), 4)


@query("binned_mean", with_fixtures(f"""
WITH b AS (SELECT cost,
  CASE WHEN date_diff('day', DATE '{DAYS_FROM}', event_date) <= 6500
       THEN greatest(ceil(date_diff('day', DATE '{DAYS_FROM}', event_date) / 500), 1) * 500 END::DOUBLE AS days_bin,
  CASE WHEN floor_area <= 590 THEN greatest(ceil(floor_area / 10), 1) * 10 END::DOUBLE AS area_bin FROM inst)
SELECT 'n_days' AS feature, days_bin AS bin, round(avg(cost), 4) AS mean_cost, CAST(count(*) AS BIGINT) AS n
FROM b WHERE days_bin IS NOT NULL GROUP BY days_bin
UNION ALL
SELECT 'floor_area', area_bin, round(avg(cost), 4), CAST(count(*) AS BIGINT) FROM b WHERE area_bin IS NOT NULL GROUP BY area_bin
""", "inst"))
def q_binned_mean(spark, sf_dir):
    """Mean cost by 500-day bins (to 6,500) and by 10 m2 bins (to 590)."""
    inst = _inst(spark, sf_dir).withColumn("n_days", days_since("event_date", DAYS_FROM))
    d = X.binned_mean(inst, bin_up("n_days", 500, 6500), "cost").select(F.lit("n_days").alias("feature"), "*")
    a = X.binned_mean(inst, bin_up("floor_area", 10, 590), "cost").select(F.lit("floor_area").alias("feature"), "*")
    return rounded(d.unionByName(a), 4)


_FORMS = ["Detached", "Semi-Detached", "End-Terrace", "Mid-Terrace"]


@query("dummy_totals", with_fixtures("""
SELECT feature, CAST(total AS BIGINT) AS total FROM (
  SELECT 'built_form_' || v AS feature, sum(CASE WHEN built_form = v THEN 1 ELSE 0 END) AS total
  FROM inst, (VALUES ('Detached'), ('Semi-Detached'), ('End-Terrace'), ('Mid-Terrace')) t(v) GROUP BY v) s
""", "inst"))
def q_dummy_totals(spark, sf_dir):
    """Column totals of 0/1 features, largest first."""
    df = one_hot(_inst(spark, sf_dir), {"built_form": _FORMS})
    return X.column_totals(df, [f"built_form_{v}" for v in _FORMS])


@query("lag_stats", with_fixtures("""
SELECT round(quantile_cont(g, 0.5), 4) AS median_days, round(avg(g), 4) AS mean_days, round(max(g), 4) AS max_days
FROM (SELECT CAST(date_diff('day', inspection_date, event_date) AS DOUBLE) AS g FROM inst) t
""", "inst"))
def q_lag_stats(spark, sf_dir):
    """Median / mean / max days from certificate to installation."""
    return rounded(X.gap_stats(_inst(spark, sf_dir), "event_date", "inspection_date"), 4)


@query("correlations", with_fixtures(f"""
WITH b AS (SELECT cost, floor_area, rooms, date_diff('day', DATE '{DAYS_FROM}', event_date) AS n_days FROM inst)
SELECT 'floor_area' AS feature, round(corr(floor_area, cost), 6) AS correlation FROM b
UNION ALL SELECT 'rooms', round(corr(rooms, cost), 6) FROM b
UNION ALL SELECT 'n_days', round(corr(n_days, cost), 6) FROM b
""", "inst"))
def q_correlations(spark, sf_dir):
    """Pearson correlation of each numeric feature with cost."""
    inst = _inst(spark, sf_dir).withColumn("n_days", days_since("event_date", DAYS_FROM))
    return rounded(X.correlations(inst, "cost", ["floor_area", "rooms", "n_days"]))


@query("histogram_fixed", with_fixtures("""
WITH r AS (SELECT cost, property_type = 'Bungalow' AS sub,
             CAST(least(floor((cost - 3500) / 500), 42) AS BIGINT) AS bin
           FROM inst WHERE cost >= 3500 AND cost <= 25000),
c AS (SELECT bin, count(*) AS n, count_if(sub) AS ns FROM r GROUP BY bin),
t AS (SELECT sum(n) AS tn, sum(ns) AS ts FROM c),
b AS (SELECT range AS bin FROM range(43))
SELECT b.bin, CAST(3500 + b.bin * 500 AS DOUBLE) AS bin_lower, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
  round(CAST(coalesce(c.n, 0) AS DOUBLE) / (CAST(t.tn AS DOUBLE) * 500.0), 10) AS density,
  CAST(coalesce(c.ns, 0) AS BIGINT) AS n_subset,
  round(CAST(coalesce(c.ns, 0) AS DOUBLE) / (CAST(t.ts AS DOUBLE) * 500.0), 10) AS density_subset
FROM b LEFT JOIN c USING (bin), t
""", "inst"))
def q_histogram_fixed(spark, sf_dir):
    """Cost histogram 3,500-25,000 in 500 bins: counts and densities, all rows and bungalows."""
    out = X.histogram_fixed(_inst(spark, sf_dir), "cost", 3500.0, 25000.0, 500.0,
                            subset=F.col("property_type") == "Bungalow")
    return rounded(out, 10)


@query("median_by_category", with_fixtures("""
SELECT 'built_form_' || v AS feature, round(quantile_cont(CASE WHEN built_form = v THEN cost END, 0.5), 4) AS median_cost,
  round((SELECT quantile_cont(cost, 0.5) FROM inst), 4) AS overall_median_cost
FROM inst, (VALUES ('Detached'), ('Semi-Detached'), ('End-Terrace'), ('Mid-Terrace')) t(v) GROUP BY v
""", "inst"))
def q_median_by_category(spark, sf_dir):
    """Median cost within each category next to the overall median."""
    df = one_hot(_inst(spark, sf_dir), {"built_form": _FORMS})
    return rounded(X.median_by_flag(df, "cost", [f"built_form_{v}" for v in _FORMS]), 4)


@query("percentile_bounds", with_fixtures("""
SELECT 'cost' AS feature, round(quantile_cont(cost, 0.01), 4) AS p_low, round(quantile_cont(cost, 0.99), 4) AS p_high FROM inst
UNION ALL SELECT 'floor_area', round(quantile_cont(floor_area, 0.01), 4), round(quantile_cont(floor_area, 0.99), 4) FROM inst
UNION ALL SELECT 'rooms', round(quantile_cont(rooms, 0.01), 4), round(quantile_cont(rooms, 0.99), 4) FROM inst
""", "inst"))
def q_percentile_bounds(spark, sf_dir):
    """1st and 99th percentiles (nulls ignored) of cost, floor area and rooms."""
    return rounded(X.percentile_bounds(_inst(spark, sf_dir), ["cost", "floor_area", "rooms"]), 4)


@query("value_counts", with_fixtures(
    "SELECT rooms, CAST(count(*) AS BIGINT) AS n FROM inst WHERE rooms IS NOT NULL GROUP BY rooms", "inst"))
def q_value_counts(spark, sf_dir):
    """Records per room count, most frequent first."""
    return X.value_counts(_inst(spark, sf_dir), "rooms")


@query("residual_trend", with_fixtures("""
WITH r AS (SELECT y - y_pred AS res, y_pred, lo FROM preds)
SELECT 'y_pred' AS feature, round(regr_slope(res, y_pred), 6) AS slope, round(regr_intercept(res, y_pred), 4) AS intercept,
       CAST(regr_count(res, y_pred) AS BIGINT) AS n FROM r
UNION ALL
SELECT 'lo', round(regr_slope(res, lo), 6), round(regr_intercept(res, lo), 4), CAST(regr_count(res, lo) AS BIGINT) FROM r
""", "preds"))
def q_residual_trend(spark, sf_dir):
    """Trend line (slope, intercept) of residuals against each numeric variable."""
    out = X.residual_trend(_resid(spark, sf_dir), "res", ["y_pred", "lo"])
    return out.select("feature", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@query("residual_box", with_fixtures("""
WITH r AS (SELECT grp, y - y_pred AS res FROM preds),
q AS (SELECT grp, quantile_cont(res, 0.25) AS q1, quantile_cont(res, 0.5) AS median, quantile_cont(res, 0.75) AS q3
      FROM r GROUP BY grp)
SELECT grp, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(CASE WHEN res >= q1 - 1.5 * (q3 - q1) THEN res END), 4) AS whisker_low,
  round(max(CASE WHEN res <= q3 + 1.5 * (q3 - q1) THEN res END), 4) AS whisker_high,
  CAST(count_if(res < q1 - 1.5 * (q3 - q1) OR res > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM r JOIN q USING (grp) GROUP BY grp, q1, median, q3
""", "preds"))
def q_residual_box(spark, sf_dir):
    """Residual box-plot numbers per category: quartiles, whiskers, outlier count."""
    return rounded(X.box_stats(_resid(spark, sf_dir), "res", ["grp"]), 4)


@query("residual_histogram", with_fixtures("""
WITH r AS (SELECT y - y_pred AS res FROM preds),
m AS (SELECT min(res) AS mn, max(res) AS mx FROM r),
c AS (SELECT CAST(least(floor((res - mn) * 30 / (mx - mn)), 29) AS BIGINT) AS bin, count(*) AS n FROM r, m GROUP BY 1),
b AS (SELECT range AS bin FROM range(30))
SELECT b.bin, round(mn + b.bin * ((mx - mn) / 30), 4) AS bin_lower, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM b CROSS JOIN m LEFT JOIN c USING (bin)
""", "preds"))
def q_residual_histogram(spark, sf_dir):
    """Residual histogram: 30 equal bins from min to max."""
    return rounded(X.histogram_range(_resid(spark, sf_dir), "res", 30), 4)


def _qq_values():
    return ", ".join(f"({i + 1}, {p}, {z!r})" for i, (p, z) in enumerate(X.normal_grid(QQ_PROBS)))


@query("residual_qq", with_fixtures(f"""
WITH g(i, p, theoretical) AS (VALUES {_qq_values()}),
q AS (SELECT quantile_cont(y - y_pred, [{", ".join(str(p) for p in QQ_PROBS)}]) AS qs FROM preds)
SELECT round(CAST(p AS DOUBLE), 6) AS p, round(CAST(theoretical AS DOUBLE), 6) AS theoretical,
       round(qs[i], 4) AS sample
FROM g, q
""", "preds"))
def q_residual_qq(spark, sf_dir):
    """Q-Q points: residual percentiles on a 1..99 % grid against standard-normal quantiles."""
    out = X.qq_points(_resid(spark, sf_dir), "res", QQ_PROBS)
    return out.select(F.round("p", 6).alias("p"), F.round("theoretical", 6).alias("theoretical"),
                      F.round("sample", 4).alias("sample"))


@query("kfold_assign", with_fixtures("""
SELECT unit_id, CAST(CAST(('0x' || substr(md5('42|' || CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold
FROM (SELECT DISTINCT unit_id FROM inst) t
""", "inst"))
def q_kfold_assign(spark, sf_dir):
    """Stable 5-fold assignment of units by key hash (seed 42)."""
    units = _inst(spark, sf_dir).select("unit_id").distinct()
    return assign_folds(units, "unit_id", 5, 42)


@query("kfold_equal", with_fixtures("""
SELECT unit_id, CAST((row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42|' || CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT), unit_id) - 1)
       % 5 AS INTEGER) AS fold
FROM (SELECT DISTINCT unit_id FROM inst) t
""", "inst"))
def q_kfold_equal(spark, sf_dir):
    """Five folds of units in hash order, their sizes equal but for one."""
    units = materialise(_inst(spark, sf_dir).select("unit_id").distinct())
    return assign_equal_folds(units, "unit_id", 5, 42)


@query("weighted_quantiles", with_fixtures("""
WITH w AS (SELECT property_type, age_band, cost, CASE WHEN event_date >= DATE '1996-01-01' THEN 2 ELSE 1 END AS w FROM inst WHERE cost IS NOT NULL),
s AS (SELECT property_type, age_band, cost, sum(w) AS w FROM w GROUP BY ALL),
c AS (SELECT *, sum(w) OVER (PARTITION BY property_type, age_band ORDER BY cost) AS upto, sum(w) OVER (PARTITION BY property_type, age_band) AS total FROM s)
SELECT property_type, age_band, round(min(cost) FILTER (upto >= 0.1 * total), 4) AS q10, round(min(cost) FILTER (upto >= 0.5 * total), 4) AS q50,
       round(min(cost) FILTER (upto >= 0.9 * total), 4) AS q90
FROM c GROUP BY property_type, age_band
""", "inst"))
def q_weighted_quantiles(spark, sf_dir):
    """10, 50 and 90 % points of the cost by type and band, late events counting twice."""
    inst = _inst(spark, sf_dir).withColumn("w", F.when(F.col("event_date") >= F.lit("1996-01-01").cast("date"), 2).otherwise(1))
    out = weighted_quantiles(inst, ["property_type", "age_band"], "cost", "w", [0.1, 0.5, 0.9])
    return out.select("property_type", "age_band", *[F.round(f"q{i}", 4).alias(n) for i, n in enumerate(("q10", "q50", "q90"))])


@query("train_test_split", with_fixtures("""
SELECT unit_id, CAST(('0x' || substr(md5('42|' || CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
FROM (SELECT DISTINCT unit_id FROM inst) t
""", "inst"))
def q_train_test_split(spark, sf_dir):
    """Stable 80/20 split of units by key hash (seed 42)."""
    units = _inst(spark, sf_dir).select("unit_id").distinct()
    return train_test_flag(units, "unit_id", 20, 42)
