"""Model queries (rows-only checks where a fit is iterative; searches' plans and closed forms have SQL).

Training data is the flagship clean table on the stand-in data. All settings
are the source's: rounds, depths, leaf and split sizes, rates, grids, folds.
Every fit runs on Spark over the whole table. Queries that need the same fit
share it: it is made once for a session and folder, and its rows are written.
"""

from __future__ import annotations

import functools
import itertools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from costlens import config as C
from costlens.models import baselines as B
from costlens.models import search as S
from costlens.models.crossval import (cross_validate_interval, point_metrics, point_predictions, residual_intervals,
                                      summary_per_feature)
from costlens.models.quantile_boost import BoostBatch, interval_batch
from costlens.models.quantile_linear import fit_linear_quantiles
from costlens.operators.knn import knn_mean
from costlens.operators.metrics import error_metrics, interval_metrics
from costlens.operators.quantiles import exact_quantiles
from costlens.operators.split import train_test_flag
from costlens.plans.materialise import broadcast_if_small, materialise
from costlens.plans.model_table import model_table, relevant_records
from costlens.plans.model_table_queries import _CLEAN_SQL as CLEAN_SQL
from costlens.plans.model_table_queries import FIXTURE_CFG, FIXTURE_LEVELS, clean_model_table, fixture_inputs
from costlens.plans.registry import query
from costlens.session import checkpoint_dir
from costlens.sources.fixtures import fixture, with_fixtures

FEATURES = ["n_days", "floor_area", "rooms",
            "built_form_detached", "built_form_mid_terrace", "built_form_semi_detached",
            "property_type_bungalow",
            "age_band_between_1930_1966", "age_band_between_1965_1983", "age_band_between_1983_2007",
            "age_band_pre_1929",
            "region_name_africa", "region_name_america", "region_name_asia", "region_name_scotland",
            "region_name_wales"]


_SHARED: dict = {}


def once(fn):
    """``fn(spark, sf_dir)`` kept for the session and folder, so that queries over one fit do not fit it again."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir, fn.__name__)
        if key not in _SHARED:
            _SHARED[key] = fn(spark, sf_dir)
        return _SHARED[key]

    return run


@once
def training_table(spark, sf_dir):
    """The clean model table, written once (many passes read it)."""
    return materialise(clean_model_table(spark, sf_dir))


@once
def interval_fit(spark, sf_dir):
    """(models, written predictions with the features) of the lower and upper model at the presets' rounds."""
    df = training_table(spark, sf_dir)
    batch = interval_batch(df, FEATURES, "cost", *C.INTERVAL_QUANTILES, C.LOWER_MODEL, C.UPPER_MODEL, C.RANDOM_STATE,
                           keep=["unit_id", *FEATURES])
    preds = materialise(batch.predictions().select("unit_id", *FEATURES, "y_true", F.get("pred", 0).alias("y_pred_lower"),
                                                   F.get("pred", 1).alias("y_pred_upper")))
    batch.close()
    return batch.models, preds


@query("quantile_boost")
def q_quantile_boost(spark, sf_dir):
    """Lower (0.1) and upper (0.9) quantile boosting, 450 rounds each; predictions table with the features kept."""
    return interval_fit(spark, sf_dir)[1]


@query("quantile_importance")
def q_quantile_importance(spark, sf_dir):
    """Feature importances (summed split gains) of both saved and reloaded quantile models, largest first."""
    out = None
    for bound, model in zip(("lower", "upper"), interval_fit(spark, sf_dir)[0]):
        path = f"{checkpoint_dir(spark).rstrip('/')}/importance-{bound}-{abs(hash(sf_dir))}"
        model.save(spark, path)
        part = B.feature_importance(spark, type(model).load(spark, path)).withColumn("bound", F.lit(bound))
        out = part if out is None else out.unionByName(part)
    return out


@query("linear_quantile")
def q_linear_quantile(spark, sf_dir):
    """Linear quantile regression (0.1 and 0.9) by re-weighted least squares; predictions table."""
    df = training_table(spark, sf_dir)
    lo, hi = fit_linear_quantiles(df, FEATURES, "cost", C.INTERVAL_QUANTILES)
    return df.select("unit_id", F.col("cost").alias("y_true"), lo.predict_column().alias("y_pred_lower"),
                     hi.predict_column().alias("y_pred_upper"))


@query("cross_validate")
def q_cross_validate(spark, sf_dir):
    """5-fold cross-validation of the interval models at the presets' rounds: metrics per (fold, split)."""
    return cross_validate_interval(training_table(spark, sf_dir), "unit_id", FEATURES, "cost")


# The stand-in dates end in 1998.
LATE = "1996-01-01"
DUMMIES = [c for c in FEATURES if c.startswith(("built_form_", "property_type_", "age_band_", "region_name_"))]


def _weighted(spark, sf_dir):
    return training_table(spark, sf_dir).withColumn(
        "weight", F.when(F.col("event_date") >= F.lit(LATE).cast("date"), 2.0).otherwise(1.0))


@once
def held_out_point_fit(spark, sf_dir):
    """(model, written rows with features, test flag, prediction, residual) of the point model fitted on 80 % of the units."""
    df = train_test_flag(_weighted(spark, sf_dir), "unit_id", 20, C.RANDOM_STATE)
    keep = ["unit_id", "event_date", "built_form", "property_type", "age_band", "region_name", *FEATURES]
    batch = BoostBatch(df.withColumn("_test", F.col("is_test").cast("int")), FEATURES, "cost",
                       [B.point_spec(len(FEATURES), fold=1)], keep, "_test", "weight")
    batch.advance(B.POINT_ROUNDS)
    rows = materialise(batch.predictions().select(*keep, (F.col("fold") == 1).alias("is_test"), "y_true", F.get("pred", 0).alias("y_pred"),
                                                  (F.col("y_true") - F.get("pred", 0)).alias("residual")))
    batch.close()
    return batch.models[0], rows


@query("point_boost")
def q_point_boost(spark, sf_dir):
    """Point model: 500 rounds, absolute loss, weighted median leaves, date weights (2 from a date on); error metrics."""
    return error_metrics(held_out_point_fit(spark, sf_dir)[1], "y_true", "y_pred", by=["is_test"])


@query("predictions_with_residuals")
def q_predictions_with_residuals(spark, sf_dir):
    """Point prediction, residual and bounds (prediction plus linear residual quantiles of the training units) of every unit."""
    rows = held_out_point_fit(spark, sf_dir)[1]
    lo, hi = fit_linear_quantiles(rows.where("not is_test"), FEATURES, "residual", C.INTERVAL_QUANTILES)
    return rows.select("unit_id", *FEATURES, "is_test", "y_true", "y_pred", "residual",
                       (F.col("y_pred") + lo.predict_column()).alias("y_pred_lower"),
                       (F.col("y_pred") + hi.predict_column()).alias("y_pred_upper"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Feature importances of the point model, largest first."""
    return B.feature_importance(spark, held_out_point_fit(spark, sf_dir)[0])


@query("residual_report")
def q_residual_report(spark, sf_dir):
    """Residuals of the point model on the held-out units: trend against each number, box statistics in each category."""
    rows = held_out_point_fit(spark, sf_dir)[1].where("is_test")
    numbers = ["y_pred", "floor_area", "rooms", "n_days"]
    long = rows.select("residual", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x"))
                                                       for c in numbers])).alias("v")).select("v.variable", "v.x", "residual")
    trend = long.groupBy("variable").agg(F.regr_slope("residual", "x").alias("slope"), F.regr_intercept("residual", "x").alias("intercept"),
                                         F.count("residual").alias("n"))
    box = rows.select("residual", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("level")) for c in
                                                      ("built_form", "property_type", "age_band", "region_name")])).alias("v"))
    box = box.select("v.variable", "v.level", "residual")
    q = broadcast_if_small(exact_quantiles(box, ["variable", "level"], "residual", [0.25, 0.5, 0.75]))
    inside = F.col("residual").between(F.col("q0") - 1.5 * (F.col("q2") - F.col("q0")), F.col("q2") + 1.5 * (F.col("q2") - F.col("q0")))
    stats = box.join(q, ["variable", "level"]).groupBy("variable", "level", "q0", "q1", "q2").agg(
        F.min(F.when(inside, F.col("residual"))).alias("whisker_low"), F.max(F.when(inside, F.col("residual"))).alias("whisker_high"),
        F.count("residual").alias("n"))
    none = F.lit(None).cast("double")
    return trend.select("variable", F.lit(None).cast("string").alias("level"), "slope", "intercept", none.alias("q1"), none.alias("median"),
                        none.alias("q3"), none.alias("whisker_low"), none.alias("whisker_high"), "n").unionByName(
        stats.select("variable", "level", none.alias("slope"), none.alias("intercept"), F.col("q0").alias("q1"), F.col("q1").alias("median"),
                     F.col("q2").alias("q3"), "whisker_low", "whisker_high", "n"))


@once
def point_folds(spark, sf_dir):
    return materialise(point_predictions(_weighted(spark, sf_dir), "unit_id", FEATURES, "cost", ["event_date", *FEATURES],
                                         weight_col="weight"))


@once
def point_fold_metrics(spark, sf_dir):
    return materialise(point_metrics(point_folds(spark, sf_dir), DUMMIES, "event_date", LATE))


@query("cross_validate_point")
def q_cross_validate_point(spark, sf_dir):
    """5-fold metrics of the point model, the constant and the model per feature, on train and test rows, all and late ones."""
    return point_fold_metrics(spark, sf_dir)


@query("summary_per_feature")
def q_summary_per_feature(spark, sf_dir):
    """Mean over the folds of the point model's metrics, per feature and period."""
    return summary_per_feature(point_fold_metrics(spark, sf_dir), by=["period"])


@query("residual_interval")
def q_residual_interval(spark, sf_dir):
    """5-fold interval metrics of the point model plus linear quantiles of its residuals."""
    return residual_intervals(point_folds(spark, sf_dir), FEATURES)


@query("baseline_models")
def q_baseline_models(spark, sf_dir):
    """Trees, forest, boosting (100 trees) and linear (OLS, lasso, ridge, elastic net) baselines: R2 / MAE on train and test."""
    df = train_test_flag(training_table(spark, sf_dir), "unit_id", 20, C.RANDOM_STATE)
    return B.evaluate_baselines(df, "is_test", FEATURES, "cost", B.baseline_estimators("cost"))


_SUMS = """SELECT avg(CAST(floor_area AS DOUBLE)) AS ma, avg(CAST(rooms AS DOUBLE)) AS mr, avg(cost) AS my,
  covar_pop(floor_area, floor_area) AS aa, covar_pop(floor_area, rooms) AS ar, covar_pop(rooms, rooms) AS rr,
  covar_pop(cost, floor_area) AS ay, covar_pop(cost, rooms) AS ry, count(*) AS n FROM ({t}) c"""
_OLS_SQL = f"""
SELECT round(a, 6) AS floor_area, round(b, 6) AS rooms, round(my - a * ma - b * mr, 4) AS intercept FROM (
  SELECT *, (ay * rr - ry * ar) / (aa * rr - ar * ar) AS a, (ry * aa - ay * ar) / (aa * rr - ar * ar) AS b
  FROM ({_SUMS.format(t=CLEAN_SQL)}) s) t
"""
_RIDGE_SQL = f"""
SELECT round(n * ay / (n * aa + 1.0), 6) AS floor_area, round(my - n * ay / (n * aa + 1.0) * ma, 4) AS intercept
FROM ({_SUMS.format(t=CLEAN_SQL)}) s
"""


def _coefficients(spark, fitted):
    coef, intercept = fitted
    row = {**{c: round(v, 6) for c, v in coef.items()}, "intercept": round(intercept, 4)}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))


@query("linear_ols", _OLS_SQL)
def q_linear_ols(spark, sf_dir):
    """Least squares of the cost on floor area and rooms, from one distributed moment matrix."""
    return _coefficients(spark, B.fit_least_squares(training_table(spark, sf_dir), ["floor_area", "rooms"], "cost"))


@query("ridge", _RIDGE_SQL)
def q_ridge(spark, sf_dir):
    """Ridge regression (penalty 1) of the cost on floor area."""
    return _coefficients(spark, B.fit_least_squares(training_table(spark, sf_dir), ["floor_area"], "cost", 1.0))


def _knn_sql():
    """Brute force over all pairs of a test and a training row of the clean table."""
    scale = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(FEATURES))
    z = ", ".join(f"(CAST({c} AS DOUBLE) - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS z{i}" for i, c in enumerate(FEATURES))
    square = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(FEATURES)))
    return f"""
WITH t AS (SELECT *, CAST(('0x' || substr(md5('{C.RANDOM_STATE}|' || CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
           FROM ({CLEAN_SQL}) c),
s AS (SELECT {scale} FROM t WHERE NOT is_test),
x AS (SELECT unit_id, cost, is_test, {z} FROM t, s),
d AS (SELECT a.unit_id, b.cost, row_number() OVER (PARTITION BY a.unit_id ORDER BY round({square}, 9), b.unit_id) AS rn
      FROM x a JOIN x b ON a.is_test AND NOT b.is_test)
SELECT unit_id, round(avg(cost), 6) AS knn_mean FROM d WHERE rn <= 5 GROUP BY unit_id
"""


@query("knn_mean", _knn_sql())
def q_knn_mean(spark, sf_dir):
    """Mean cost of the five training units nearest to each test unit in scaled features."""
    df = train_test_flag(training_table(spark, sf_dir), "unit_id", 20, C.RANDOM_STATE)
    out = knn_mean(df.filter(F.col("is_test")), df.filter(~F.col("is_test")), FEATURES, "cost", "unit_id", 5)
    return out.select("unit_id", F.round("knn_mean", 6).alias("knn_mean"))


@once
def halving_results(spark, sf_dir):
    df = train_test_flag(training_table(spark, sf_dir), "unit_id", 20, C.RANDOM_STATE)
    table, best = S.halving_search(df.where(~F.col("is_test")), FEATURES, "cost", "unit_id", C.INTERVAL_QUANTILES,
                                   seed=C.RANDOM_STATE)
    return table, best, df


_HALVING_SCHEMA = ("alpha double, rung long, candidate long, learning_rate double, max_depth long, min_samples_leaf long, "
                   "min_samples_split long, rounds long, score double, kept boolean")


@query("halving_search")
def q_halving_search(spark, sf_dir):
    """Successive halving of both bounds over the 400-point grid, 50 to 500 rounds, by 5-fold pinball loss: the score table."""
    return S.results_frame(spark, halving_results(spark, sf_dir)[0], _HALVING_SCHEMA)


@query("tuned_interval")
def q_tuned_interval(spark, sf_dir):
    """The search's best settings refitted on all training units: interval metrics on train and test."""
    _, best, df = halving_results(spark, sf_dir)
    batch = interval_batch(df.withColumn("_test", F.col("is_test").cast("int")), FEATURES, "cost", *C.INTERVAL_QUANTILES,
                           *[best[a] for a in C.INTERVAL_QUANTILES], fold_col="_test", folds=(1,))
    rows = batch.predictions().select(F.when(F.col("fold") == 1, "test").otherwise("train").alias("split"), "y_true",
                                      F.get("pred", 0).alias("lo"), F.get("pred", 1).alias("hi"))
    return interval_metrics(rows, "y_true", "lo", "hi", ["split"])


_RANDOM_SCHEMA = ("candidate long, n_estimators long, learning_rate double, max_depth long, min_samples_leaf long, "
                  "min_samples_split long, train_mae double, mae double, mae_std double, best boolean, refit_train_mae double, "
                  "refit_test_mae double")


@query("random_search")
def q_random_search(spark, sf_dir):
    """Random search of squared-loss boosting by 5-fold MAE: 15 candidates, the winner refitted and tested."""
    df = train_test_flag(training_table(spark, sf_dir), "unit_id", 20, C.RANDOM_STATE)
    return S.results_frame(spark, S.random_search(df, "is_test", FEATURES, "cost", "unit_id", seed=C.RANDOM_STATE), _RANDOM_SCHEMA)


# The source's choices, in its order; its dates moved to the stand-in's years.
DATA_CHOICES = {"double_from": [None, "1995-01-01", "1997-04-01"], "cost_bounds": ["fixed", "percentiles"],
                "rooms_choice": ["bounds", "categorical"], "area_choice": ["fixed", "percentiles", "none"],
                "start_date": [C.MIN_DATE, "1992-01-01"]}
MODEL_CHOICES = {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.05, 0.1], "max_depth": [3, 5, 10],
                 "min_samples_split": [2, 5, 10], "min_samples_leaf": [50, 100]}
COST_BOUNDS, AREA_BOUNDS, ROOMS_BOUNDS = (3500.0, 25000.0), (20.0, 500.0), (2.0, 8.0)
CANDIDATES, CHUNK = 200, 25
CLEANED_AT_ONCE = 4


def _choice(at, values, after):
    """SQL: the entry of ``values`` that combination ``i`` has, ``after`` combinations of later choices."""
    case = " ".join(f"WHEN {j} THEN {'NULL' if v is None else repr(v)}" for j, v in enumerate(values))
    expr = f"CASE (i // {after}) % {len(values)} {case} END"
    return f"CAST({expr} AS DOUBLE) AS {at}" if isinstance(values[0], float) else f"{expr} AS {at}"


def _choice_list():
    every = DATA_CHOICES | MODEL_CHOICES
    after, out = 1, []
    for name, values in reversed(every.items()):
        out.append((name, values, after))
        after *= len(values)
    return list(reversed(out)), after


_CHOICES, COMBINATIONS = _choice_list()
_PLAN_SQL = with_fixtures(f"""
WITH pick AS (
  SELECT i, row_number() OVER (ORDER BY md5('{C.RANDOM_STATE}|' || CAST(i AS VARCHAR))) - 1 AS candidate
  FROM (SELECT unnest(range({COMBINATIONS})) AS i) r ORDER BY 2 LIMIT {CANDIDATES}),
named AS (SELECT candidate, {", ".join(_choice(*c) for c in _CHOICES)} FROM pick),
q AS (SELECT quantile_cont(cost, 0.01) AS c1, quantile_cont(cost, 0.99) AS c2, quantile_cont(floor_area, 0.01) AS a1,
             quantile_cont(floor_area, 0.99) AS a2 FROM inst)
SELECT CAST(candidate AS BIGINT) AS candidate, {", ".join(DATA_CHOICES)}, {", ".join(MODEL_CHOICES)},
       round(CASE cost_bounds WHEN 'fixed' THEN {COST_BOUNDS[0]} ELSE c1 END, 4) AS cost_low,
       round(CASE cost_bounds WHEN 'fixed' THEN {COST_BOUNDS[1]} ELSE c2 END, 4) AS cost_high,
       round(CASE area_choice WHEN 'fixed' THEN {AREA_BOUNDS[0]} WHEN 'percentiles' THEN a1 END, 4) AS area_low,
       round(CASE area_choice WHEN 'fixed' THEN {AREA_BOUNDS[1]} WHEN 'percentiles' THEN a2 END, 4) AS area_high,
       CAST(dense_rank() OVER (ORDER BY cost_bounds, area_choice, rooms_choice) - 1 AS BIGINT) AS cleaned,
       CAST(candidate // {CHUNK} AS BIGINT) AS chunk
FROM named, q
""", "inst")


def choice_bounds(spark, sf_dir):
    """1st and 99th percentiles of cost and floor area over all records, nulls left out."""
    inst = fixture(spark, sf_dir, "inst")
    return {c: tuple(exact_quantiles(inst, [], c, [0.01, 0.99]).first()) for c in ("cost", "floor_area")}


def choice_plan(spark, sf_dir):
    """The sampled candidates (dicts), each with its bounds and the number of the cleaned table that it shares with others."""
    bounds = choice_bounds(spark, sf_dir)
    order = spark.range(COMBINATIONS).orderBy(F.md5(F.concat(F.lit(f"{C.RANDOM_STATE}|"), F.col("id").cast("string")))).limit(CANDIDATES)
    rows = []
    for candidate, (i,) in enumerate(order.collect()):  # CANDIDATES rows
        c = {name: values[i // after % len(values)] for name, values, after in _CHOICES}
        cost = COST_BOUNDS if c["cost_bounds"] == "fixed" else bounds["cost"]
        area = {"fixed": AREA_BOUNDS, "percentiles": bounds["floor_area"], "none": (None, None)}[c["area_choice"]]
        rows.append({"candidate": candidate, **c, "cost_low": cost[0], "cost_high": cost[1], "area_low": area[0], "area_high": area[1],
                     "chunk": candidate // CHUNK})
    prefixes = sorted({(r["cost_bounds"], r["area_choice"], r["rooms_choice"]) for r in rows})
    for r in rows:
        r["cleaned"] = prefixes.index((r["cost_bounds"], r["area_choice"], r["rooms_choice"]))
    return rows


_PLAN_SCHEMA = ("candidate long, double_from string, cost_bounds string, rooms_choice string, area_choice string, start_date string, "
                "n_estimators int, learning_rate double, max_depth int, min_samples_split int, min_samples_leaf int, "
                "cost_low double, cost_high double, area_low double, area_high double, cleaned long, chunk long")


@query("data_choice_plan", _PLAN_SQL)
def q_data_choice_plan(spark, sf_dir):
    """The 200 candidates sampled from the 11,664 data and model choices, their bounds, shared cleaned tables and chunks."""
    out = S.results_frame(spark, choice_plan(spark, sf_dir), _PLAN_SCHEMA)
    return out.withColumns({c: F.round(c, 4) for c in ("cost_low", "cost_high", "area_low", "area_high")})


ROOM_DUMMIES = [f"number_of_rooms_{i}" for i in range(2, 8)]


def cleaned_for(inputs, choice):
    """(table, features) of one data choice: the clean job with its bounds, written once.

    ``inputs`` are the relevant records, which all choices share, locations and price factors.
    """
    rows, locations, factors = inputs
    categorical = choice["rooms_choice"] == "categorical"
    area = (None, None) if choice["area_choice"] == "none" else (choice["area_low"], choice["area_high"])
    cfg = FIXTURE_CFG.__class__(**{**FIXTURE_CFG.__dict__, "cost_bounds": (choice["cost_low"], choice["cost_high"]),
                                   "floor_area_bounds": area, "rooms_bounds": (None, None) if categorical else ROOMS_BOUNDS})
    table = materialise(model_table(rows, locations, factors, FIXTURE_LEVELS, cfg, rooms_as_categorical=categorical, relevant=True))
    cols = [c for c in FEATURES if not (c == "floor_area" and choice["area_choice"] == "none") and not (c == "rooms" and categorical)]
    return table, [*cols, *([c for c in ROOM_DUMMIES if c in table.columns] if categorical else [])]


@query("data_choice_search")
def q_data_choice_search(spark, sf_dir):
    """Search over data choices: 200 of 11,664 candidates, the point model's 5-fold metrics of each by split.

    Candidates with the same cleaned table share it, and those that also
    weigh its rows alike share a fit: as in the source, the model choices are
    listed but not passed to the fit, and another start date moves one
    feature by a constant, which changes no tree. Results are written by
    chunks of 25 fits.
    """
    plan = choice_plan(spark, sf_dir)
    weights = dict(enumerate(DATA_CHOICES["double_from"]))
    fit_of = {r["candidate"]: (r["cleaned"], DATA_CHOICES["double_from"].index(r["double_from"])) for r in plan}
    fits = sorted(set(fit_of.values()))
    choices = {r["cleaned"]: r for r in plan}
    inst, locations, factors = fixture_inputs(spark, sf_dir)
    inputs = relevant_records(inst, FIXTURE_CFG), materialise(locations), factors
    tables: dict = {}

    def run(chunk):
        new = sorted({t for t, _ in chunk} - tables.keys())
        with ThreadPoolExecutor(CLEANED_AT_ONCE) as pool:  # a table alone leaves cores idle in its small steps
            tables.update(zip(new, pool.map(lambda t: cleaned_for(inputs, choices[t]), new)))
        got = S.choice_scores({t: tables[t] for t, _ in chunk}, weights, chunk, "cost", "event_date", "unit_id")
        names = F.create_map(*itertools.chain.from_iterable((F.lit(i), F.lit(fits.index(f))) for i, f in enumerate(chunk)))
        return got.withColumn("fit", F.try_element_at(names, F.col("group"))).drop("group")

    folder = f"{checkpoint_dir(spark).rstrip('/')}/choices-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    scores = S.in_chunks(spark, fits, CHUNK, folder, run).drop("chunk")
    named = S.results_frame(spark, [{**r, "fit": fits.index(fit_of[r["candidate"]])} for r in plan], _PLAN_SCHEMA + ", fit long")
    return named.join(F.broadcast(scores), "fit").drop("fit")  # two rows a fit


@query("interval_report")
def q_interval_report(spark, sf_dir):
    """Interval metrics of the fitted lower/upper models on their training table."""
    return interval_metrics(interval_fit(spark, sf_dir)[1], "y_true", "y_pred_lower", "y_pred_upper")
