"""Point model with absolute loss, baseline trees and linear models, feature importance.

Fits are batches of boosted trees or Spark ML estimators; metrics are Spark
aggregates on the prediction frames. Only fitted-model summaries reach the
driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.models.quantile_boost import BoostBatch, QuantileBoostModel
from costlens.models.tree_growth import Spec
from costlens.operators.metrics import error_metrics

# Fixed settings of the point model.
POINT_ROUNDS = 500
POINT_MIN_LEAF = 64


def assembled(df: DataFrame, features: list, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def point_spec(n_features: int, rounds: int = POINT_ROUNDS, fold: int | None = None, group: int | None = None,
               features: tuple | None = None, seed: int = 0) -> Spec:
    """Settings of the point model: absolute loss, weighted median leaves, splits among the root of the features' number."""
    return Spec(0.5, rounds, 3, POINT_MIN_LEAF, 2, 0.1, fold, max(1, math.isqrt(n_features)), seed, "quantile", group, features)


def fit_point_model(df: DataFrame, features: list, label: str, weight_col: str | None = None, rounds: int = POINT_ROUNDS,
                    track_loss: bool = False, seed: int = 0) -> QuantileBoostModel:
    """Boosted trees for the (weighted) median: absolute loss, leaves renewed by weighted medians.

    A missing feature or label is an error: the clean job leaves none.
    """
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate([*features, label])]).first()
    bad = [c for c, n in zip([*features, label], missing) if n]
    if bad:
        raise ValueError(f"missing values in {bad}")
    batch = BoostBatch(df, features, label, [point_spec(len(features), rounds, seed=seed)], weight_col=weight_col)
    batch.advance(rounds, track_loss=track_loss)
    batch.close()
    return batch.models[0]


def baseline_estimators(label: str, seed: int = 42, n_trees: int = 100) -> dict:
    """Name -> Spark ML regressor: a single tree, a forest and the four linear models."""
    return {
        "decision_tree": DecisionTreeRegressor(labelCol=label, seed=seed),
        "random_forest": RandomForestRegressor(labelCol=label, numTrees=n_trees, seed=seed),
        "linear_ols": LinearRegression(labelCol=label),
        "lasso": LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=1.0),
        "ridge": LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=0.0),
        "elastic_net": LinearRegression(labelCol=label, regParam=1.0, elasticNetParam=0.5),
    }


def evaluate_baselines(data: DataFrame, is_test: str, features: list, label: str, estimators: dict,
                       boosting_rounds: int = 100, seed: int = 42) -> DataFrame:
    """Fit each model on the rows that are not ``is_test``; R2, MAE and median error on both (one row per model x split).

    ``gradient_boosting`` (squared loss, ``boosting_rounds`` trees of depth 3) is grown here; both boosting variants of
    the source map to it, as features are binned.
    """
    spec = Spec(0.5, boosting_rounds, fold=1, seed=seed, loss="squared")
    batch = BoostBatch(data.withColumn("_test", F.col(is_test).cast("int")), features, label, [spec], fold_col="_test")
    batch.advance(boosting_rounds)
    split = lambda c: F.when(c, "test").otherwise("train").alias("split")
    long = batch.predictions().select(F.lit("gradient_boosting").alias("model"), split(F.col("fold") == 1),
                                      F.col("y_true").alias("_y"), F.get("pred", 0).alias("_p"))
    rows = assembled(data, features)
    train = rows.where(~F.col(is_test))
    for name, est in estimators.items():
        long = long.unionByName(est.fit(train).transform(rows).select(
            F.lit(name).alias("model"), split(F.col(is_test)), F.col(label).cast("double").alias("_y"), F.col("prediction").alias("_p")))
    return error_metrics(long, "_y", "_p", ["model", "split"]).select("model", "split", "r2", "mae", "mdae", "n")


def feature_importance(spark: SparkSession, model: QuantileBoostModel) -> DataFrame:
    """(feature, importance) by falling importance: shares of the summed split gains, ties by name."""
    rows = sorted(model.importance().items(), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


# ------------------------------------------------------------------ linear models in closed form
def moments(df: DataFrame, features: list, label: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Centred moment matrix of (features, label), their means and the number of rows, from one scan.

    Rows with a null are left out. A task adds up its rows around the first of
    them, and its (p + 2) squared sums are merged on the executors.
    """
    cols = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*features, label])]
    rows = df.select(*cols).na.drop()
    width = len(cols)

    def run(frames):
        n, mean, m2 = 0.0, np.zeros(width), np.zeros((width, width))
        for f in frames:
            x = f.to_numpy(dtype=np.float64)
            if not len(x):
                continue
            k, mu = float(len(x)), x.mean(axis=0)
            c = x - mu
            delta = mu - mean
            m2 += c.T @ c + np.outer(delta, delta) * n * k / (n + k)
            mean, n = mean + delta * k / (n + k), n + k
        if n:
            yield pd.DataFrame({"g": [0], "n": [n], "mean": [mean.tolist()], "m2": [m2.ravel().tolist()]})

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        n, mean, m2 = 0.0, np.zeros(width), np.zeros((width, width))
        for k, mu, c in zip(f["n"], f["mean"], f["m2"]):
            delta = np.asarray(mu) - mean
            m2 += np.asarray(c).reshape(width, width) + np.outer(delta, delta) * n * k / (n + k)
            mean, n = mean + delta * k / (n + k), n + k
        return pd.DataFrame({"g": [0], "n": [n], "mean": [mean.tolist()], "m2": [m2.ravel().tolist()]})

    schema = "g int, n double, mean array<double>, m2 array<double>"
    part = rows.mapInPandas(run, schema)
    # Two steps, so that no task merges more than the root of the number of partitions.
    part = part.withColumn("s", (F.spark_partition_id() % 64).cast("int"))
    part = part.groupBy("s").applyInPandas(lambda f: merge(f), schema).groupBy("g").applyInPandas(merge, schema)
    got = part.first()
    if got is None:
        return np.zeros((width, width)), np.zeros(width), 0.0
    return np.array(got["m2"]).reshape(width, width), np.array(got["mean"]), float(got["n"])


def fit_least_squares(df: DataFrame, features: list, label: str, ridge: float = 0.0) -> tuple[dict, float]:
    """(coefficients, intercept) of least squares with a penalty ``ridge`` on the squared coefficients.

    Features that others determine share their effect with the least norm.
    """
    m, mean, n = moments(df, features, label)
    p = len(features)
    if not n:
        return {c: float("nan") for c in features}, float("nan")
    coef = np.linalg.pinv(m[:p, :p] + ridge * np.eye(p), rcond=1e-10, hermitian=True) @ m[:p, p]
    return dict(zip(features, coef.tolist())), float(mean[p] - coef @ mean[:p])
