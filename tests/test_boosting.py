"""Boosted trees against brute force, and the same trees however the rows are spread."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from costlens.models import baselines as B
from costlens.models import quantile_boost
from costlens.models.quantile_boost import BoostBatch, QuantileBoostModel, bin_edges, fit_quantile_boost
from costlens.models.tree_growth import (BigLeaf, Growth, Spec, Tree, from_sortable, grow_subtree, lower_quantile, place_of,
                                         quantile_of, sortable)


def lower(values, weights, alpha):
    order = np.argsort(values, kind="stable")
    sums = np.cumsum(weights[order])
    return values[order][min(np.searchsorted(sums, alpha * sums[-1] - 1e-9 * sums[-1]), len(sums) - 1)]


def naive_tree(x, res, w, spec, depth=0):
    """(rows -> value, gains) by trying every cut of every feature at every node."""
    g = np.where(res > 0, w, 0.0)
    best = (0.0, None, None)
    if depth < spec.max_depth and len(x) >= max(2, spec.min_samples_split):
        for f in range(x.shape[1]):
            for c in np.unique(x[:, f])[:-1]:
                k = x[:, f] <= c
                if min(k.sum(), (~k).sum()) < spec.min_samples_leaf:
                    continue
                wl, wr = w[k].sum(), w[~k].sum()
                gain = (g[k].sum() * wr - g[~k].sum() * wl) ** 2 / (wl * wr * (wl + wr))
                if gain > best[0]:
                    best = (gain, f, c)
    if best[1] is None:
        return np.full(len(x), lower(res, w, spec.alpha)), []
    k = x[:, best[1]] <= best[2]
    out, gains = np.empty(len(x)), [best[0]]
    for side in (k, ~k):
        out[side], more = naive_tree(x[side], res[side], w[side], spec, depth + 1)
        gains += more
    return out, gains


@pytest.mark.parametrize("spec", [Spec(0.1, max_depth=4), Spec(0.9, max_depth=3, min_samples_leaf=20),
                                  Spec(0.5, max_depth=6, min_samples_split=60), Spec(0.5, max_depth=0)])
def test_tree_equals_brute_force(spec):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, 500), rng.integers(0, 2, 500), rng.integers(0, 5, 500), np.zeros(500)]).astype(np.uint8)
    res = rng.normal(0, 1, 500) + 0.3 * x[:, 0] - x[:, 1]
    w = rng.integers(1, 3, 500).astype(float)
    tree = grow_subtree(x, res, w, [12, 2, 5, 1], spec, 0)
    want, gains = naive_tree(x, res, w, spec)
    assert np.allclose(tree.value[tree.nodes_of(x)], want)
    assert np.allclose(sorted(tree.gain[tree.left >= 0]), sorted(gains))
    assert sum(tree.count[tree.left < 0]) == 500


def table(spark, n=1500, seed=0):
    rng = np.random.default_rng(seed)
    d = pd.DataFrame({"id": range(n), "x1": rng.uniform(0, 10, n), "x2": rng.integers(0, 2, n).astype(float), "x3": rng.integers(0, 6, n),
                      "w": rng.integers(1, 3, n).astype(float), "fold": rng.integers(0, 3, n)})
    d["y"] = 100 + 20 * d.x1 + 50 * d.x2 + rng.normal(0, 10, n) * (1 + d.x3)
    return d, spark.createDataFrame(d)


FEATURES = ["x1", "x2", "x3"]
SPECS = [Spec(0.1, 4, 4, 5, 10, 0.2, 0), Spec(0.9, 3, 2, 1, 50, 0.3, 1), Spec(0.5, 4, 3, 1, 2, 0.1, None, 2),
         Spec(0.5, 3, 3, loss="squared", fold=2)]


def plain(d, edges, spec, rounds):
    """Predictions of a straightforward loop over the rounds."""
    x = np.column_stack([np.searchsorted(e, d[c], side="left") for e, c in zip(edges, FEATURES)]).astype(np.uint8)
    train = np.ones(len(d), bool) if spec.fold is None else (d.fold != spec.fold).to_numpy()
    y, w = d.y.to_numpy(), d.w.to_numpy()
    pred = np.full(len(d), lower(y[train], w[train], spec.alpha))
    for r in range(rounds):
        tree = grow_subtree(x[train], (y - pred)[train], w[train], [len(e) + 1 for e in edges], spec, r)
        pred += spec.learning_rate * tree.value[tree.nodes_of(x)]
    return pred


def test_batch_equals_a_plain_loop_and_local_equals_spread(spark):
    d, df = table(spark)
    got = {}
    for parts, local in ((3, 10_000), (5, 100), (2, 0)):  # one task a tree, mixed, and no node finished by one task
        b = BoostBatch(df.repartition(parts), FEATURES, "y", SPECS, ["id"], "fold", "w", max_bins=16, local_rows=local, rewrite_every=3)
        b.advance(4)
        rows = b.predictions().orderBy("id").collect()
        got[local] = np.array([r["pred"] for r in rows])
        if local == 10_000:
            for m in range(3):
                assert np.allclose(got[local][:, m], plain(d, b.edges, SPECS[m], SPECS[m].n_estimators))
            for m, model in enumerate(b.models):  # the flat model scores as the batch does
                assert np.allclose(model.predict_numpy(d[FEATURES].to_numpy(float)), got[local][:, m])
                assert len(model.trees) == SPECS[m].n_estimators
        b.close()
    for local in (100, 0):
        assert np.allclose(got[local], got[10_000])


def test_groups_use_their_rows_and_features_only(spark):
    d, df = table(spark, 600)
    specs = [Spec(0.5, 3, group=0), Spec(0.5, 3, group=1, features=(1, 2)), Spec(0.1, 2, group=0, fold=2)]
    b = BoostBatch(df.withColumn("g", F.col("id") % 2), FEATURES, "y", specs, ["id"], "fold", group_col="g", max_bins=16)
    b.advance(3)
    assert b.slots == [0, 0, 1]
    assert not any((t.feature[t.left >= 0] == 0).any() for t in b.models[1].trees) and any((t.feature == 0).any() for t in b.models[0].trees)
    alone = BoostBatch(df.where("id % 2 = 0"), FEATURES, "y", [Spec(0.5, 3)], ["id"], max_bins=16)
    alone.edges, alone.bins = b.edges, b.bins
    rows = {r["id"]: r["pred"] for r in b.predictions().collect()}
    even = b.models[0].predict_numpy(d[d.id % 2 == 0][FEATURES].to_numpy(float))
    assert np.allclose(even, [rows[i][0] for i in range(0, 600, 2)])
    assert b.counts == [300.0, 300.0, float(((d.id % 2 == 0) & (d.fold != 2)).sum())]


def test_nulls_empty_folds_and_clashing_columns(spark):
    _, df = table(spark, 200)
    broken = df.withColumn("x1", F.when(F.col("id") > 3, F.col("x1"))).withColumn("y", F.when(F.col("id") != 9, F.col("y")))
    b = BoostBatch(broken.withColumn("_x", F.lit(1)).withColumn("_pred", F.lit("a")), FEATURES, "y",
                   [Spec(0.5, 2), Spec(0.5, 2, fold=None, group=None)], ["id", "_x", "_pred", "x2"])
    b.advance(2)
    assert b.predictions().count() == 195 and set(b.predictions().columns) >= {"_x", "_pred", "x2", "pred"}
    none = BoostBatch(df.limit(0), FEATURES, "y", [Spec(0.5, 2)])
    none.advance(2)
    assert np.isnan(none.models[0].init) and none.models[0].trees == [] and none.predictions().count() == 0


def test_edges(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": np.arange(1000.0), "b": [0.0, 1.0] * 500, "c": 5.0}))
    a, b, c = bin_edges(df, ["a", "b", "c"], 16)
    assert len(a) == 15 and b == [0.5] and c == []
    sizes = np.bincount(np.searchsorted(a, np.arange(1000.0), side="left"))
    assert sizes.min() >= 60 and sizes.max() <= 65


def test_point_model_loss_falls_and_weights_pull(spark):
    _, df = table(spark)
    model = B.fit_point_model(df, FEATURES, "y", "w", rounds=12, track_loss=True)
    assert all(a > b for a, b in zip(model.train_loss, model.train_loss[1:]))
    with pytest.raises(ValueError, match="x2"):
        B.fit_point_model(df.withColumn("x2", F.when(F.col("id") > 0, F.col("x2"))), FEATURES, "y", rounds=1)


def test_importance_of_a_loaded_model_equals_sql_over_its_nodes(spark, tmp_dir):
    import duckdb

    _, df = table(spark)
    fit_quantile_boost(df, FEATURES, "y", 0.9, 5).save(spark, tmp_dir + "/m")
    got = {r["feature"]: r["importance"] for r in B.feature_importance(spark, QuantileBoostModel.load(spark, tmp_dir + "/m")).collect()}
    want = dict(duckdb.sql(f"""
        SELECT feature, sum(share) / (SELECT count(DISTINCT tree) FROM '{tmp_dir}/m/nodes/*.parquet' WHERE "left" >= 0)
        FROM (SELECT tree, feature, sum(gain) / sum(sum(gain)) OVER (PARTITION BY tree) AS share
              FROM '{tmp_dir}/m/nodes/*.parquet' WHERE "left" >= 0 GROUP BY tree, feature) GROUP BY feature""").fetchall())
    assert abs(sum(got.values()) - 1) < 1e-12
    assert all(abs(got[f] - want.get(i, 0.0)) < 1e-12 for i, f in enumerate(FEATURES))


def test_sorted_bits_and_long_quantile():
    v = np.array([-np.inf, -3.5, -1e-300, -0.0, 0.0, 2.5, 1e300])
    s = sortable(v)
    assert (np.diff(s.astype(object)) >= 0).all() and [from_sortable(int(b)) for b in s] == list(v + 0.0)
    rng = np.random.default_rng(1)
    values, w = rng.normal(0, 100, 3000), rng.integers(1, 4, 3000).astype(float)
    leaf = BigLeaf()
    while not leaf.done:
        digit, weight = leaf.cells(values, w)
        d = np.unique(digit)
        leaf.choose(d, np.bincount(digit, weights=weight)[d], 0.3)
    assert leaf.value == lower(values, w, 0.3)


def test_closed_forms_against_numpy(spark):
    d, df = table(spark, 500)
    x = np.column_stack([d[FEATURES].to_numpy(float), np.ones(500)])
    want = np.linalg.lstsq(x, d.y.to_numpy(), rcond=None)[0]
    coef, intercept = B.fit_least_squares(df.repartition(7), FEATURES, "y")
    assert np.allclose([*coef.values(), intercept], want)
    xc = x[:, :3] - x[:, :3].mean(axis=0)
    want = np.linalg.solve(xc.T @ xc + 2.5 * np.eye(3), xc.T @ (d.y - d.y.mean()).to_numpy())
    assert np.allclose(list(B.fit_least_squares(df, FEATURES, "y", 2.5)[0].values()), want)


def test_tree_bytes_round_trip():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, (100, 2)).astype(np.uint8)
    t = grow_subtree(x, rng.normal(size=100), np.ones(100), [9, 9], Spec(0.5, max_depth=5), 0)
    back = Tree.from_bytes(t.to_bytes())
    assert all((getattr(t, n) == getattr(back, n)).all() for n, _ in Tree.FIELDS)


def test_quantile_in_a_bracket_is_that_of_all_values():
    rng = np.random.default_rng(5)
    for v in (rng.normal(0, 1, 30_000), rng.integers(0, 40, 20_000).astype(float), np.sort(rng.normal(0, 1, 20_000)), np.zeros(9_000),
              np.concatenate([np.zeros(15_000), rng.normal(9, 1, 5_000)]), rng.normal(0, 1, 50)):
        w = rng.integers(1, 3, len(v)).astype(float)
        for alpha in (0.001, 0.1, 0.5, 0.9, 0.999):
            assert quantile_of(v, alpha) == lower(v, np.ones(len(v)), alpha)
            assert quantile_of(v, alpha, w) == lower(v, w, alpha)


def test_places_of_many_leaves_are_those_of_their_running_sums():
    size = np.arange(1, 400)
    for alpha in (0.1, 0.3, 0.5, 0.7, 0.9):
        for weight in (1.0, 2.0, 3.0):
            want = [lower_quantile(np.arange(1, n + 1) * weight, alpha, n * weight) for n in size]
            assert place_of(size, alpha, weight).tolist() == want


@pytest.mark.parametrize("loss", ["quantile", "squared"])
def test_a_deep_tree_is_split_a_level_at_a_time(monkeypatch, loss):
    """Node by node the arrays were copied for each split, so the time grew with the square of the leaves."""
    def one_by_one(*_):
        raise AssertionError("a node was split alone")

    monkeypatch.setattr(Tree, "split", one_by_one)
    rng = np.random.default_rng(6)
    x = rng.integers(0, 60, (4000, 4)).astype(np.uint8)
    res, w, spec = rng.normal(0, 1, 4000), np.ones(4000), Spec(0.7, max_depth=20, loss=loss)
    tree = grow_subtree(x, res, w, [60] * 4, spec, 0)
    again, leaf = Growth(x, w, [60] * 4, spec).tree(res, 0)
    assert (tree.left < 0).sum() > 1000
    for name in ("feature", "cut", "left", "value", "gain", "count"):
        assert np.array_equal(getattr(tree, name), getattr(again, name))
    assert np.array_equal(leaf, tree.nodes_of(x))
    for node in np.flatnonzero(tree.left < 0):
        of = np.sort(res[leaf == node])
        assert tree.value[node] == pytest.approx(of.mean() if loss == "squared" else lower(of, np.ones(len(of)), 0.7))


def test_whole_models_send_few_bytes_of_trees_a_job(spark, monkeypatch):
    """Deep trees went through the driver for all rounds at once, and searches kept them there."""
    _, df = table(spark, 600)
    specs = [Spec(0.5, 6, 12), Spec(0.5, 6, 2, fold=1), Spec(0.5, 3, 12, loss="squared")]
    got, sent = [], []
    grow = BoostBatch._grow_models

    def noted(self, chosen, first, end):
        size = grow(self, chosen, first, end)
        sent.append(sum(size[m] * (min(end, specs[m].n_estimators) - first) for m in chosen))
        return size

    monkeypatch.setattr(BoostBatch, "_grow_models", noted)
    for most, keep in ((1 << 28, True), (60_000, False)):
        monkeypatch.setattr(quantile_boost, "TREE_BYTES_A_JOB", most)
        b = BoostBatch(df, FEATURES, "y", specs, ["id"], "fold", max_bins=16, keep_trees=keep)
        sent.clear()
        b.advance(6)
        got.append([r["pred"] for r in b.predictions().orderBy("id").collect()])
        assert [len(m.trees) for m in b.models] == ([6, 6, 3] if keep else [0, 0, 0])
        b.close()
    assert len(sent) > 1 and max(sent) <= 60_000
    assert np.allclose(got[0], got[1])
