"""Nearest-neighbour means against brute force, with slices far smaller than the data."""

import numpy as np
import pandas as pd
import pytest

from costlens.operators.knn import _within_reach, build_tree, knn_mean, leaves_of


@pytest.mark.parametrize("leaf_rows, block_rows, sample", [(20, 50, 200), (256, 4096, 50_000), (10, 3, 40)])
def test_like_brute_force(spark, leaf_rows, block_rows, sample):
    rng = np.random.default_rng(8)
    data = pd.DataFrame({"id": rng.permutation(600), "a": rng.normal(size=600).round(1), "b": rng.integers(0, 2, 600).astype(float),
                         "c": rng.exponential(3, 600).round(0), "v": rng.normal(size=600)})
    data.loc[:150, ["a", "b", "c"]] = [0.5, 1.0, 2.0]  # a hot cell
    query = pd.DataFrame({"k": range(90), "a": rng.normal(size=90).round(1) * 3, "b": rng.integers(0, 2, 90).astype(float), "c": rng.exponential(5, 90).round(0)})
    q = spark.createDataFrame(query).selectExpr("k", "if(k = 3, null, a) AS a", "b", "c")
    got = {r["k"]: r["knn_mean"] for r in knn_mean(q, spark.createDataFrame(data), ["a", "b", "c"], "v", "id", 5,
                                                                leaf_rows=leaf_rows, block_rows=block_rows, sample=sample).collect()}
    x = data[["a", "b", "c"]].to_numpy()
    mean, std = x.mean(axis=0), x.std(axis=0)
    assert len(got) == 90 and got[3] is None
    for r in query.itertuples(index=False):
        if r.k == 3:
            continue
        d = (((np.array([r.a, r.b, r.c]) - x) / std) ** 2).sum(axis=1).round(9)
        near = np.lexsort((data.id, d))[:5]
        assert np.isclose(got[r.k], data.v.to_numpy()[near].mean()), r


def test_few_rows_and_none(spark):
    q = spark.createDataFrame([(1.0,), (None,)], "a double")
    d = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 7.0), (3, None, 9.0)], "id long, a double, v double")
    assert sorted(str(r["knn_mean"]) for r in knn_mean(q, d, ["a"], "v", "id").collect()) == ["6.0", "None"]
    assert {r["knn_mean"] for r in knn_mean(q, d.where("id > 9"), ["a"], "v", "id").collect()} == {None}


def test_tree_cuts_all_but_equal_rows():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=500), rng.integers(0, 2, 500), np.r_[np.zeros(400), rng.normal(size=100)]])
    x[:120] = [0.3, 1.0, 0.0]  # equal rows stay together, whatever the wanted size
    tree = build_tree(x, 10)
    sizes = np.bincount(leaves_of(x, tree))
    assert sizes.sum() == 500 and sorted(sizes)[-1] >= 120 and (sizes > 10).sum() == 1


def test_most_pairs_are_never_compared(spark):
    """Rows that lie in clusters: the boxes out of reach are not asked."""
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 50, (40, 6))
    x = centre[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 6))
    tree = build_tree(x, 60)
    leaf = leaves_of(x, tree)
    low = np.array([x[leaf == i].min(axis=0) for i in range(leaf.max() + 1)])
    high = np.array([x[leaf == i].max(axis=0) for i in range(leaf.max() + 1)])
    asked = pd.DataFrame({"id": range(4000), "x": list(x), "leaf": leaf, "r": 3.0})
    out = pd.concat(_within_reach(low, high)([asked]))
    size = np.bincount(leaf)
    assert (size[leaf].sum() + size[out["leaf"]].sum()) < 0.05 * 4000 * 4000
