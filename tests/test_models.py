"""Model invariants and source/sink round trips."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from costlens.models.quantile_boost import QuantileBoostModel, fit_quantile_boost
from costlens.models.quantile_linear import fit_linear_quantile
from costlens.sources import readers


def _frame(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.uniform(0, 10, n)
    x2 = rng.integers(0, 2, n).astype(float)
    y = 100 + 20 * x1 + 50 * x2 + rng.normal(0, 10, n)
    return spark.createDataFrame(pd.DataFrame({"x1": x1, "x2": x2, "y": y}))


def test_constant_feature_gives_sample_quantile(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": np.zeros(101), "y": np.arange(101.0)}))
    m = fit_quantile_boost(df, ["x"], "y", 0.9, n_estimators=3, max_depth=2)
    pred = m.transform(df).agg(F.max("prediction"), F.min("prediction")).first()
    assert abs(pred[0] - 90.0) < 1e-9 and abs(pred[1] - 90.0) < 1e-9


def test_pinball_falls_and_coverage(spark):
    df = _frame(spark)
    lo = fit_quantile_boost(df, ["x1", "x2"], "y", 0.1, n_estimators=8, max_depth=3, learning_rate=0.3,
                            track_loss=True)
    assert lo.train_loss[-1] < lo.train_loss[0]
    share_below = lo.transform(df).agg(F.avg((F.col("y") < F.col("prediction")).cast("double"))).first()[0]
    assert 0.03 < share_below < 0.2


def test_model_save_load_roundtrip(spark, tmp_dir):
    df = _frame(spark, 500)
    m = fit_quantile_boost(df, ["x1", "x2"], "y", 0.5, n_estimators=2, max_depth=2)
    m.save(spark, tmp_dir)
    back = QuantileBoostModel.load(spark, tmp_dir)
    x = np.array([[1.0, 0.0], [9.0, 1.0]])
    assert np.allclose(m.predict_numpy(x), back.predict_numpy(x))


def test_linear_quantile_recovers_line(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, 4000)
    y = 3.0 + 2.0 * x + rng.uniform(-1, 1, 4000)       # uniform noise: 90 % line is 3.8 + 2x
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    m = fit_linear_quantile(df, ["x"], "y", 0.9)
    assert abs(m.coef[0] - 2.0) < 0.05 and abs(m.intercept - 3.8) < 0.1
    share = m.transform(df).agg(F.avg((F.col("y") <= F.col("prediction")).cast("double"))).first()[0]
    assert abs(share - 0.9) < 0.02


def test_csv_sources_and_sinks(spark, tmp_dir):
    import os
    pc = os.path.join(tmp_dir, "pc.csv")
    with open(pc, "w", encoding="latin-1") as f:
        f.write("pcds,ladcd,ladnm,extra\nAB1 2CD,E1,Ynys Môn,x\n")
    got = readers.read_postcode_lookup(spark, pc).first()
    assert got.postcode == "AB12CD" and got.ladnm == "Ynys Môn"
    rg = os.path.join(tmp_dir, "rg.csv")
    with open(rg, "w") as f:
        f.write("LAD24CD,LAD24NM,RGN24CD,RGN24NM,ObjectId\nE1,A,R1,North,7\n")
    r = readers.read_region_lookup(spark, rg).first()
    assert (r.ladcd, r.rgnnm, r.fid) == ("E1", "North", 7)
    preds = spark.createDataFrame([(1, 10.0, 8.0, 12.0)], "unit_id long, y_true double, y_pred_lower double, y_pred_upper double")
    for fmt in ("csv", "json", "parquet"):
        path = os.path.join(tmp_dir, f"out_{fmt}")
        readers.write_table(preds, path, fmt)
        back = readers.read_table(spark, path, fmt, schema=preds.schema)
        assert [tuple(x) for x in back.collect()] == [(1, 10.0, 8.0, 12.0)]


def test_boosting_keeps_one_frame_and_no_tree_files(spark):
    """The persisted frames do not grow with the rounds, and no per-round folder stays behind."""
    import os

    from costlens.session import checkpoint_dir

    df = _frame(spark, 300)
    held = spark.sparkContext._jsc.getPersistentRDDs
    before = len(held())
    fit_quantile_boost(df, ["x1", "x2"], "y", 0.5, n_estimators=6, max_depth=2, rewrite_every=2)
    assert len(held()) <= before
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("tree-")]


def test_linear_quantiles_in_one_pass_converge(spark, tmp_dir):
    from costlens.models.quantile_linear import LinearQuantileModel, fit_linear_quantiles

    df = _frame(spark, 2000).repartition(9)
    lo, hi = fit_linear_quantiles(df, ["x1", "x2"], "y", [0.1, 0.9])
    assert lo.converged and hi.converged
    n = df.count()
    for m, q in ((lo, 0.1), (hi, 0.9)):
        p = df.withColumn("p", m.predict_column())
        below, upto = p.agg(F.count_if(F.col("y") < F.col("p") - 1e-3), F.count_if(F.col("y") <= F.col("p") + 1e-3)).first()
        assert below / n <= q + 1e-9 and upto / n >= q - 1e-9  # the optimum leaves q between these shares
    one = fit_linear_quantile(df, ["x1", "x2"], "y", 0.9)
    assert np.allclose(one.coef, hi.coef, rtol=1e-3)
    hi.save(spark, tmp_dir + "/m")
    assert LinearQuantileModel.load(spark, tmp_dir + "/m").coef == hi.coef
    import pytest
    with pytest.warns(UserWarning):
        assert not fit_linear_quantile(df, ["x1", "x2"], "y", 0.9, max_iter=2).converged


def test_linear_quantiles_of_groups_equal_separate_fits_in_fewer_passes(spark, monkeypatch):
    """The folds were fitted one after the other, each with all its passes over the rows."""
    from costlens.models import crossval as V
    from costlens.models import quantile_linear as Q

    rng = np.random.default_rng(8)
    n = 900
    d = pd.DataFrame({"x1": rng.uniform(0, 10, n), "x2": rng.integers(0, 2, n), "fold": rng.integers(0, 3, n), "y_true": 0.0})
    d["y_pred"] = 5 * d.x1 + rng.normal(0, 1, n) * (1 + d.fold)
    d["y_true"] = d.y_pred + 3 * d.x2 + rng.normal(0, 1, n) * (1 + d.x1)
    d["split"] = np.where(rng.uniform(size=n) < 0.7, "train", "test")
    df = spark.createDataFrame(d).withColumn("res", F.col("y_true") - F.col("y_pred")).cache()
    got = Q.fit_linear_quantiles_by(df, "fold", [0, 1, 2, 7], ["x1", "x2"], "res", [0.1, 0.9])
    for f in range(3):
        for one, m in zip(Q.fit_linear_quantiles(df.where(F.col("fold") == f), ["x1", "x2"], "res", [0.1, 0.9]), got[f]):
            assert np.allclose([one.intercept, *one.coef], [m.intercept, *m.coef]) and one.converged == m.converged
    assert all(np.isnan(m.intercept) for m in got[7])

    fits = []
    by = V.fit_linear_quantiles_by
    monkeypatch.setattr(V, "fit_linear_quantiles_by", lambda *a, **k: fits.append(a[2]) or by(*a, **k))
    rows = {(r["fold"], r["split"]): r for r in V.residual_intervals(df.drop("res"), ["x1", "x2"]).collect()}
    assert fits == [[0, 1, 2]] and set(rows) == {(f, s) for f in range(3) for s in ("train", "test")}
