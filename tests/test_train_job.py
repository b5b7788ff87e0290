"""The training job over landed files writes predictions, metrics and models that can be read back."""

from pyspark.sql import functions as F

from costlens import config as C
from costlens.models.quantile_boost import QuantileBoostModel
from costlens.plans import catalog  # noqa: F401
from costlens.plans.model_table_queries import FIXTURE_REF_YEAR, SOURCE_FIXTURE_CFG, SOURCE_LEVELS, land_files
from costlens.plans.train_job import train, training_inputs, tune, validate

SF = "/root/testdata/sf0.001"


def test_written_outputs(spark, tmp_dir):
    paths = land_files(spark, SF, tmp_dir + "/in")
    table = training_inputs(spark, paths, SOURCE_LEVELS, SOURCE_FIXTURE_CFG, FIXTURE_REF_YEAR)
    features = list(C.NUMERIC_FEATURES) + [f"{c}_{v}" for c, vs in SOURCE_LEVELS.items() for v in vs]
    metrics = train(spark, table, tmp_dir + "/out", features, n_estimators=2).first()
    fit_rows = table.where("adjusted_cost is not null").count()
    assert metrics["n"] == fit_rows > 0 and 0 <= metrics["coverage"] <= 1
    preds = spark.read.option("header", True).csv(tmp_dir + "/out/predictions")
    assert preds.columns == ["original_mcs_index", "y_true", "y_pred_lower", "y_pred_upper"] and preds.count() == fit_rows
    saved = spark.read.json(tmp_dir + "/out/metrics").first()
    assert saved["n"] == fit_rows and abs(saved["coverage"] - metrics["coverage"]) < 1e-12
    upper = QuantileBoostModel.load(spark, tmp_dir + "/out/model_upper")
    again = upper.transform(table.na.drop(subset=[*features, "adjusted_cost"]), "p").agg(F.sum("p")).first()[0]
    assert abs(again - preds.agg(F.sum(F.col("y_pred_upper").cast("double"))).first()[0]) < 1e-6 * abs(again)


def test_validate_and_tune_write_their_results(spark, tmp_dir):
    paths = land_files(spark, SF, tmp_dir + "/in")
    table = training_inputs(spark, paths, SOURCE_LEVELS, SOURCE_FIXTURE_CFG, FIXTURE_REF_YEAR).cache()
    features = ["TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS"]
    n = table.na.drop(subset=[*features, "adjusted_cost"]).count()
    means = {r["split"]: r for r in validate(spark, table, tmp_dir + "/v", features, k=3, n_estimators=2).collect()}
    folds = spark.read.json(tmp_dir + "/v/fold_metrics")
    assert folds.count() == 6 and folds.where("split = 'test'").agg(F.sum("n")).first()[0] == n
    want = folds.where("split = 'train'").agg(F.avg("coverage")).first()[0]
    assert abs(means["train"]["coverage"] - want) < 1e-12 and spark.read.json(tmp_dir + "/v/mean_metrics").count() == 2

    grid = {"learning_rate": [0.1, 0.3], "max_depth": [1, 2], "min_samples_leaf": [1, 20], "min_samples_split": [2]}
    got = {r["split"]: r for r in tune(spark, table, tmp_dir + "/t", features, grid=grid, min_rounds=2, max_rounds=8, k=2).collect()}
    assert got["train"]["n"] + got["test"]["n"] == n and got["train"]["pct_lower_below"] >= got["train"]["pct_both_below"]
    scores = spark.read.json(tmp_dir + "/t/scores")
    assert scores.where("rung = 0").count() == 2 * 4 and scores.where("kept and rung = 1").count() == 2
    lower = QuantileBoostModel.load(spark, tmp_dir + "/t/model_lower")
    assert len(lower.trees) == 6 and lower.alpha == 0.1
