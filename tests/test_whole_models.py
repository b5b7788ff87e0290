"""Models of few rows grow all their rounds in one task each: the same trees, and no job a round."""

import numpy as np
import pandas as pd
import pytest

from costlens.models.quantile_boost import BoostBatch
from costlens.models.tree_growth import Growth, Spec, Tree, grow_rounds, grow_subtree


def rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    level = rng.integers(0, 5, n)
    x = np.column_stack([rng.integers(0, 64, n), rng.integers(0, 7, n), *[level == i for i in range(1, 5)], rng.integers(0, 2, n)]).astype(np.uint8)
    return x, np.round(30 * np.sin(x[:, 0] / 9) + 5 * x[:, 1] * x[:, 3] + rng.normal(0, 9, n), 1), [64, 7, 2, 2, 2, 2, 2]


@pytest.mark.parametrize("kinds", [(1.0,), (1.0, 2.0), (0.25, 0.7, 1.9)])
@pytest.mark.parametrize("spec", [Spec(0.1, 9, 10, 20, 10, 0.1), Spec(0.9, 9, 5, 1, 300, 0.2), Spec(0.5, 9, 3, 64, 2, 0.1, None, 2),
                                  Spec(0.5, 9, 3, loss="squared"), Spec(0.5, 9, 0)])
def test_rounds_equal_a_loop_of_single_trees(spec, kinds):
    x, y, bins = rows()
    w = np.random.default_rng(2).choice(kinds, len(y))
    pred = np.full(len(y), y.mean())
    got = grow_rounds(x, y, pred, w, bins, spec, 0, 5)
    for r, tree in enumerate(got):
        want = grow_subtree(x, y - pred, w, bins, spec, r)
        pred = pred + spec.learning_rate * want.value[want.nodes_of(x)]
        assert all((getattr(tree, f) == getattr(want, f)).all() for f, _ in Tree.FIELDS)
    assert Growth(x, w, bins, spec).counts == (spec.loss == "quantile" and kinds[0] == 1)


def test_a_model_of_few_rows_takes_no_job_a_round(spark):
    d = pd.DataFrame({"a": np.arange(900.0) % 37, "b": np.arange(900) % 3, "fold": np.arange(900) % 2})
    df = spark.createDataFrame(d.assign(y=d.a * 2 + d.b + np.sin(np.arange(900.0))))
    sc = spark.sparkContext
    batch = BoostBatch(df, ["a", "b"], "y", [Spec(0.1, 60, fold=0), Spec(0.9, 40, fold=1)], ["a"], "fold")
    sc.setJobGroup("whole-models", "")
    batch.advance(20)
    batch.advance(60)
    jobs = len(sc.statusTracker().getJobIdsForGroup("whole-models"))
    sc.setJobGroup("", "")
    assert jobs <= 12 and [len(m.trees) for m in batch.models] == [60, 40] and batch.rounds == 60
    spread = BoostBatch(df, ["a", "b"], "y", [Spec(0.1, 60, fold=0), Spec(0.9, 40, fold=1)], ["a"], "fold", local_rows=0)
    spread.advance(3)
    for one, other in zip(batch.models, spread.models):
        for s, t in zip(one.trees[:3], other.trees):
            assert (s.feature == t.feature).all() or len(s.left) == len(t.left)
            assert np.allclose(sorted(s.value), sorted(t.value))
    batch.close()
    spread.close()


def test_a_level_counts_only_the_children_of_fewer_rows(monkeypatch):
    x, y, bins = rows()
    counted = []
    cells = Growth._cells
    monkeypatch.setattr(Growth, "_cells", lambda self, at, *a: (counted.append(len(x) if at is None else len(at)), cells(self, at, *a))[1])
    grow_rounds(x, y, np.zeros(len(y)), np.ones(len(y)), bins, Spec(0.5, 1, 6, 5, 2, 0.1), 0, 1)
    assert len(counted) > 3 and counted[0] == len(x) and max(counted[1:]) <= len(x) // 2


def test_rows_of_a_split_tree_end_where_its_cuts_lead():
    x, y, bins = rows()
    tree = grow_subtree(x, y, np.ones(len(y)), bins, Spec(0.5, 1, 12, 1), 0)
    for row, node in zip(x[:200], tree.nodes_of(x[:200])):
        at = 0
        while tree.left[at] >= 0:
            at = (tree.left if row[tree.feature[at]] <= tree.cut[at] else tree.right)[at]
        assert at == node
    assert (Tree.root(3.0).nodes_of(x) == 0).all() and len(tree.nodes_of(x[:0])) == 0


def test_a_model_of_six_times_the_rows_of_a_node_is_grown_by_one_task(spark, monkeypatch):
    d = pd.DataFrame({"a": np.arange(600.0) % 37, "y": np.arange(600.0) % 37 + np.sin(np.arange(600.0))})
    one, spread = (BoostBatch(spark.createDataFrame(d), ["a"], "y", [Spec(0.5, 4, 3, 5)], local_rows=n) for n in (100, 99))
    rounds, grow = [], BoostBatch._grow
    monkeypatch.setattr(BoostBatch, "_grow", lambda self, specs, r: (rounds.append((self.local_rows, r)), grow(self, specs, r))[1])
    for batch in (one, spread):
        batch.advance(4)
        batch.close()
    assert rounds == [(99, 0), (99, 1), (99, 2), (99, 3)]
    for s, t in zip(one.models[0].trees, spread.models[0].trees):
        assert sorted(s.value) == sorted(t.value)


@pytest.mark.parametrize("weights", [(1.0,), (3.0,), (1.0, 2.0)])
@pytest.mark.parametrize("spec", [Spec(0.1, 9, 10, 20, 10, 0.1), Spec(0.9, 9, 6, 1, 3000, 0.2), Spec(0.5, 9, 3, 64, 2, 0.1, None, 2)])
def test_large_nodes_parted_by_themselves_give_the_same_trees(spec, weights):
    x, y, bins = rows(20_000)
    w = np.random.default_rng(2).choice(weights, len(y))
    pred = np.full(len(y), y.mean())
    for r, tree in enumerate(grow_rounds(x, y, pred, w, bins, spec, 0, 4)):
        want = grow_subtree(x, y - pred, w, bins, spec, r)
        pred = pred + spec.learning_rate * want.value[want.nodes_of(x)]
        assert all((getattr(tree, f) == getattr(want, f)).all() for f, _ in Tree.FIELDS)


def test_a_node_of_many_rows_is_counted_by_itself(monkeypatch):
    """Before, each level looked up the node of every row that was left; now only nodes of few rows do so."""
    x, y, bins = rows(60_000)
    asked = []
    cells = Growth._cells
    monkeypatch.setattr(Growth, "_cells", lambda self, at, node, state, n: (asked.append((len(x) if at is None else len(at), n)), cells(
        self, at, node, state, n))[1])
    grow_rounds(x, y, np.zeros(len(y)), np.ones(len(y)), bins, Spec(0.5, 1, 3, 5, 2, 0.1), 0, 1)
    assert len(asked) >= 3 and all(n == 1 for size, n in asked if size > 3 * 4096)


def test_a_batch_of_rows_is_not_scored_by_the_models_of_other_groups(spark):
    d = pd.DataFrame({"a": np.arange(300.0) % 37, "g": np.arange(300) // 100, "y": np.arange(300.0)})
    batch = BoostBatch(spark.createDataFrame(d).repartition(1), ["a"], "y", [Spec(0.5, 3, 2, group=g) for g in range(3)], ["a", "g"], group_col="g")
    batch.advance(3)
    for r in batch.predictions().collect():
        assert np.isclose(r["pred"][0], batch.models[r["g"]].predict_numpy(np.array([[r["a"]]]))[0])
    batch.close()
