"""The source's jobs end to end: train (landed files -> model table -> interval models -> predictions, metrics, models),
validate (k-fold metrics) and tune (successive halving, refit, metrics on train and test rows).

Inputs are the source's files with its own column names; nothing but the
folders and the settings is given. Every table is read, transformed and
written by Spark; only model parameters and metric rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens import config as C
from costlens.models.crossval import cross_validate_interval
from costlens.models.quantile_boost import fit_interval, interval_batch, predictions_table
from costlens.models.search import HALVING_GRID, halving_search, results_frame
from costlens.operators.indexation import quarterly_factors
from costlens.operators.lookup import location_lookup
from costlens.operators.metrics import floor_metrics, interval_metrics, mean_over
from costlens.operators.split import train_test_flag
from costlens.plans.materialise import materialise
from costlens.plans.model_table import model_table
from costlens.sources import readers


@dataclass(frozen=True)
class InputPaths:
    """Where the landed files are (CSV with a header; records may be Parquet)."""

    records: str
    price_index: str
    postcode_new: str
    region_new: str
    postcode_old: str
    region_old: str


def training_inputs(spark: SparkSession, paths: InputPaths, levels: Mapping[str, Sequence],
                    cfg: C.CleanConfig = C.SOURCE_CONFIG, reference_year: int = C.PRICE_INDEX_REFERENCE_YEAR) -> DataFrame:
    """The model table, straight from the landed files."""
    locations = location_lookup(
        readers.read_postcode_lookup(spark, paths.postcode_new), readers.read_region_lookup(spark, paths.region_new),
        readers.read_postcode_lookup(spark, paths.postcode_old), readers.read_region_lookup(spark, paths.region_old))
    factors = quarterly_factors(readers.read_index_series(spark, paths.price_index), reference_year)
    return model_table(readers.read_records(spark, paths.records), locations, factors, levels, cfg)


def train(spark: SparkSession, table: DataFrame, out: str, features: Sequence[str] = C.NUMERIC_FEATURES + C.DUMMY_FEATURES,
          cfg: C.CleanConfig = C.SOURCE_CONFIG, label: str = "adjusted_cost", n_estimators: int | None = None) -> DataFrame:
    """Fit both bounds on the model table and write predictions, metrics and models under ``out``; returns the metrics.

    ``n_estimators`` replaces the presets' rounds (None: the presets).
    """
    lower, upper = fit_interval(table, list(features), label, *C.INTERVAL_QUANTILES, C.LOWER_MODEL, C.UPPER_MODEL,
                                seed=C.RANDOM_STATE, n_estimators=n_estimators)
    preds = predictions_table(table.na.drop(subset=[*features, label]), lower, upper, label, [cfg.cols.key])
    readers.write_table(preds, f"{out}/predictions", "csv")
    written = preds.schema
    metrics = interval_metrics(readers.read_table(spark, f"{out}/predictions", "csv", written),
                               "y_true", "y_pred_lower", "y_pred_upper")
    readers.write_table(metrics, f"{out}/metrics", "json")
    lower.save(spark, f"{out}/model_lower")
    upper.save(spark, f"{out}/model_upper")
    return metrics


_FEATURES = C.NUMERIC_FEATURES + C.DUMMY_FEATURES


def validate(spark: SparkSession, table: DataFrame, out: str, features: Sequence[str] = _FEATURES, cfg: C.CleanConfig = C.SOURCE_CONFIG,
             label: str = "adjusted_cost", k: int = C.KFOLD_SPLITS, n_estimators: int | None = None) -> DataFrame:
    """k-fold validation of both bounds: metrics per (fold, split) and their means under ``out``; returns the means."""
    folds = materialise(cross_validate_interval(table, cfg.cols.key, list(features), label, k, n_estimators=n_estimators))
    readers.write_table(folds, f"{out}/fold_metrics", "json")
    means = mean_over(folds, [c for c in folds.columns if c not in ("fold", "split", "n")], ["split"])
    readers.write_table(means, f"{out}/mean_metrics", "json")
    return means


def tune(spark: SparkSession, table: DataFrame, out: str, features: Sequence[str] = _FEATURES, cfg: C.CleanConfig = C.SOURCE_CONFIG,
         label: str = "adjusted_cost", grid: dict = HALVING_GRID, min_rounds: int = 50, max_rounds: int = 500,
         k: int = C.KFOLD_SPLITS, test_percent: int = 20) -> DataFrame:
    """Search of both bounds' settings on the training rows, refit of the best, metrics on train and test rows.

    Writes the score table, the metrics and both models under ``out``; returns the metrics (interval and floor metrics
    by split).
    """
    features, key, alphas = list(features), cfg.cols.key, C.INTERVAL_QUANTILES
    rows = train_test_flag(table.na.drop(subset=[*features, label]), key, test_percent, C.RANDOM_STATE)
    scores, best = halving_search(rows.where(~F.col("is_test")), features, label, key, alphas, grid, min_rounds, max_rounds, k=k,
                                  seed=C.RANDOM_STATE)
    schema = ("alpha double, rung long, candidate long, learning_rate double, max_depth long, min_samples_leaf long, "
              "min_samples_split long, rounds long, score double, kept boolean")
    readers.write_table(results_frame(spark, scores, schema), f"{out}/scores", "json")
    batch = interval_batch(rows.withColumn("_test", F.col("is_test").cast("int")), features, label, *alphas,
                           *[best[a] for a in alphas], fold_col="_test", folds=(1,))
    preds = materialise(batch.predictions().select(F.when(F.col("fold") == 1, "test").otherwise("train").alias("split"), "y_true",
                                                   F.get("pred", 0).alias("y_pred_lower"), F.get("pred", 1).alias("y_pred_upper")))
    batch.close()
    metrics = interval_metrics(preds, "y_true", "y_pred_lower", "y_pred_upper", ["split"]).join(
        floor_metrics(preds, "y_pred_lower", "y_pred_upper", by=["split"]), "split")
    readers.write_table(metrics, f"{out}/metrics", "json")
    for name, model in zip(("lower", "upper"), batch.models):
        model.save(spark, f"{out}/model_{name}")
    return metrics
