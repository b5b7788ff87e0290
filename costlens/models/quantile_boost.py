"""Quantile gradient boosting on binned features, many models in the same jobs.

Spark ML boosts squared and absolute loss only. Here every feature is cut into
bins once and the rows are written as a table of small byte strings, labels
and one prediction per model. A model is a set of settings and the fold that
it leaves out, so both bounds, all folds of a validation and all candidates of
a search grow in the same jobs:

* a model that learns from at most ``WHOLE * LOCAL_ROWS`` rows gets them in one
  task, which grows all its rounds; the models run side by side;
* of other models, a node of many rows is split from one grouped aggregate of (model, node,
  bin) -> rows, weight, weight above the prediction; its leaves, if they
  stay that large, find their exact quantile 16 bits at a time in the same way;
* a node of at most ``LOCAL_ROWS`` rows goes to one task, which grows the
  whole subtree under it with the same split rule and the same exact leaf
  quantiles. Trees do not depend on where a node was grown.

The gradient of the pinball loss takes two values, so a split needs only
counts; squared loss is there for comparison. Every ``rewrite_every`` rounds the predictions are written anew, and
until then the trees grown since travel with the job: a lost executor rereads a
table, lineage stays one scan long, and the time of a round does not grow. The
files before are deleted, so the disk holds one such table (two while one is written).
Only trees, counts and chosen splits reach the driver.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from costlens.models.tree_growth import BigLeaf, Spec, Tree, best_splits, grow_rounds, grow_subtree
from costlens.operators.quantiles import exact_quantiles
from costlens.operators.ranking import free_names
from costlens.plans.materialise import discard, materialised, release

# Rows of a node that one task takes to finish the subtree under it (about 40 bytes a row: 20 MB).
LOCAL_ROWS = 500_000
# A model of so many times these rows is one task's, which grows all its rounds (3,000,000 rows: 120 MB sent, about 140 bytes
# a row held). Larger ones share out each round, so that no task holds more.
WHOLE = 6
# Trees that one job of whole models grows, at most: they pass through the driver and travel with the next job.
TREES_A_JOB = 20_000
# Bytes of these trees, about: deep ones have thousands of leaves, and the driver takes 1 GB of results at most.
TREE_BYTES_A_JOB = 256 << 20
NODE_BYTES = sum(np.dtype(kind).itemsize for _, kind in Tree.FIELDS)
MAX_BINS = 64
# Rows times models of a row from which another task of a scan pays off (a small table is one task).
ROWS_A_TASK = 20_000


@dataclass
class FlatTree:
    """One tree as node arrays; ``left < 0`` marks a leaf. Rows up to the threshold go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray | None = None
    count: np.ndarray | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        idx = np.zeros(x.shape[0], dtype=np.int64)
        rows = np.arange(x.shape[0])
        while True:
            internal = self.left[idx] >= 0
            if not internal.any():
                return self.value[idx]
            f = np.where(internal, self.feature[idx], 0)
            go_left = x[rows, f] <= self.threshold[idx]
            nxt = np.where(go_left, self.left[idx], self.right[idx])
            idx = np.where(internal, nxt, idx)


@dataclass
class QuantileBoostModel:
    features: list
    alpha: float
    init: float
    learning_rate: float
    trees: list = field(default_factory=list)
    train_loss: list = field(default_factory=list)

    def predict_numpy(self, x: np.ndarray) -> np.ndarray:
        out = np.full(x.shape[0], self.init, dtype=np.float64)
        for t in self.trees:
            out += self.learning_rate * t.predict(x)
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add ``out`` (Arrow-batched scoring of all trees at once)."""
        model = self

        @F.pandas_udf(T.DoubleType())
        def score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols])
            return pd.Series(model.predict_numpy(x))

        return df.withColumn(out, score(*[F.col(c).cast("double") for c in self.features]))

    def importance(self) -> dict[str, float]:
        """Share of each feature in the summed gains of the trees: each tree's gains sum to one, then the mean over trees.

        Trees without a split have no part in it; without any split all shares are 0.
        """
        total = np.zeros(len(self.features))
        for t in self.trees:
            gain = np.bincount(t.feature[t.left >= 0], weights=t.gain[t.left >= 0], minlength=len(self.features))
            total += gain / gain.sum() if gain.sum() > 0 else 0.0
        return dict(zip(self.features, (total / total.sum() if total.sum() > 0 else total).tolist()))

    # ----------------------------------------------------------- persistence
    def save(self, spark: SparkSession, path: str) -> None:
        """JSON header + Parquet node table (no pickle)."""
        header = {"features": list(self.features), "alpha": self.alpha, "init": self.init,
                  "learning_rate": self.learning_rate, "n_trees": len(self.trees),
                  "train_loss": list(self.train_loss)}
        rows = []
        for t_id, t in enumerate(self.trees):
            for n in range(len(t.left)):
                rows.append((t_id, n, int(t.feature[n]), float(t.threshold[n]), int(t.left[n]),
                             int(t.right[n]), float(t.value[n]), float(t.gain[n]), float(t.count[n])))
        schema = ("tree long, node long, feature long, threshold double, left long, right long, value double, "
                  "gain double, count double")
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(path, "nodes"))
        spark.createDataFrame([(json.dumps(header),)], "header string").write.mode("overwrite").text(
            os.path.join(path, "header"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> QuantileBoostModel:
        header = json.loads(spark.read.text(os.path.join(path, "header")).first()[0])
        nodes = spark.read.parquet(os.path.join(path, "nodes")).orderBy("tree", "node").toPandas()
        trees = []
        for _, g in nodes.groupby("tree", sort=True):
            trees.append(FlatTree(*[g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value", "gain", "count")]))
        return QuantileBoostModel(header["features"], header["alpha"], header["init"],
                                  header["learning_rate"], trees, header.get("train_loss", []))


# ------------------------------------------------------------------ binning
def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """Per feature the cuts between its bins, ascending: a value up to a cut is left of it.

    A feature of at most ``max_bins`` values is cut halfway between them, any
    other at exact quantiles. No cut means a constant feature.
    """
    near = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(features)]).first()
    few = [c for i, c in enumerate(features) if near[i] <= 2 * max_bins]
    values = {}
    if few:
        row = df.agg(*[F.sort_array(F.collect_set(F.col(c))).alias(f"c{i}") for i, c in enumerate(few)]).first()
        values = {c: row[i] for i, c in enumerate(few) if len(row[i]) <= max_bins}
    edges = []
    for c in features:
        if c in values:
            edges.append([(a + b) / 2 for a, b in zip(values[c], values[c][1:])])
            continue
        probs = [i / max_bins for i in range(1, max_bins)]
        q = exact_quantiles(df, [], c, probs, method="lower").first()
        top = df.agg(F.max(c)).first()[0]
        edges.append(sorted({v for v in q if v < top}))
    return edges


def _binned(df: DataFrame, features: Sequence[str], edges: list[list[float]], out: str) -> DataFrame:
    """The rows with their bins as one byte string ``out`` in place of the features."""
    rest = [c for c in df.columns if c not in features]
    cuts = [np.array(e) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, len(cuts)), dtype=np.uint8)
            for j, c in enumerate(features):
                x[:, j] = np.searchsorted(cuts[j], b.column(c).to_numpy(zero_copy_only=False), side="left")
            cells = pa.array([r.tobytes() for r in x], type=pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [cells], names=[*rest, out])

    return df.mapInArrow(run, T.StructType([df.schema[c] for c in rest] + [T.StructField(out, T.BinaryType())]))


# ------------------------------------------------------------------ batches of models
@dataclass(frozen=True)
class _Names:
    x: str
    y: str
    w: str
    group: str
    fold: str
    pred: str


def _arrays(b: pa.RecordBatch, names: _Names, width: int, slots: int):
    """(bins, label, weight, group, fold, predictions) of a batch of the table."""
    cells = b.column(names.x)
    at = np.frombuffer(cells.buffers()[1], dtype=np.int32)[cells.offset:cells.offset + len(cells) + 1]
    x = np.frombuffer(cells.buffers()[2], dtype=np.uint8)[at[0]:at[-1]].reshape(-1, width)
    pred = b.column(names.pred).flatten().to_numpy(zero_copy_only=False).reshape(-1, slots)
    return x, *(b.column(c).to_numpy(zero_copy_only=False) for c in (names.y, names.w, names.group, names.fold)), pred


def _predicted(pred: np.ndarray, x: np.ndarray, since: list) -> np.ndarray:
    """Predictions of one model with the trees that the table does not have yet."""
    out = pred.copy()
    for rate, tree in since:
        out += rate * tree.value[tree.nodes_of(x)]
    return out


class BoostBatch:
    """Models of one table that grow together, round by round.

    Rows with a null label, feature or weight are dropped; ``fold_col`` names
    each row's fold and ``group_col`` its group (null: none), ``keep`` the
    columns that the predictions carry. A row holds one prediction for each
    model of its group, in the order of ``specs`` (``slots``). The start value
    of a model and its leaf values are exact (weighted) quantiles: the smallest
    value with at least the share ``alpha`` of the weight at or below it. A
    model without rows has no trees and a start value of NaN. ``keep_trees``
    False leaves the trees out of ``models``: the predictions have them.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, specs: Sequence[Spec], keep: Sequence[str] = (),
                 fold_col: str | None = None, weight_col: str | None = None, group_col: str | None = None,
                 max_bins: int = MAX_BINS, local_rows: int = LOCAL_ROWS, rewrite_every: int = 10,
                 keep_trees: bool = True):
        self.keep_trees = keep_trees
        self.features, self.specs, self.keep = list(features), list(specs), list(keep)
        self.local_rows, self.rewrite_every = local_rows, rewrite_every
        if not 2 <= max_bins <= 256:
            raise ValueError("max_bins must be 2 to 256")
        names = self.names = _Names(*free_names([*self.keep, *self.features], "_x", "_y", "_w", "_group", "_fold", "_pred"))
        groups = [s.group for s in self.specs]
        if None in groups and any(g is not None for g in groups):
            raise ValueError("either all models name a group or none")
        self.slots = [groups[:m].count(g) for m, g in enumerate(groups)]
        self.width = max(self.slots, default=0) + 1
        cols = [F.col(c).cast("double").alias(c) for c in self.features if c not in self.keep]
        # A kept feature stays as it is; its bins come from a copy.
        copies = dict(zip([c for c in self.features if c in self.keep],
                          free_names([*self.keep, *self.features, *vars(names).values()],
                                     *[f"_f_{c}" for c in self.features if c in self.keep])))
        cols += [F.col(c).cast("double").alias(a) for c, a in copies.items()]
        binned = [copies.get(c, c) for c in self.features]
        rows = df.select(*self.keep, *cols, F.col(label).cast("double").alias(names.y),
                         (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias(names.w),
                         *[(F.coalesce(F.col(c).cast("int"), F.lit(-1)) if c else F.lit(-1)).alias(n)
                           for c, n in ((group_col, names.group), (fold_col, names.fold))],
                         F.array_repeat(F.lit(0.0), self.width).alias(names.pred))
        rows, raw = materialised(rows.na.drop(subset=[*binned, names.y, names.w]))
        self.edges = bin_edges(rows, binned, max_bins)
        self.bins = [len(e) + 1 for e in self.edges]
        most = max(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)
        spread = max(1, min(most, math.ceil(rows.count() * self.width / ROWS_A_TASK)))
        dealt = rows.repartition(spread)
        dealt = dealt.sortWithinPartitions(names.group) if group_col else dealt  # a batch has rows of few groups
        self.spark, self.path, self.lent = rows.sparkSession, "", False
        self._put(_binned(dealt, binned, self.edges, names.x))
        discard(self.spark, raw)
        sizes = [tuple(r) for r in self.table.groupBy(names.group, names.fold).count().collect()]
        self.counts = [float(sum(n for g, f, n in sizes if s.group in (None, g) and (s.fold is None or f != s.fold)))
                       for s in self.specs]
        self.rounds = 0
        self.since: list[list] = [[] for _ in self.specs]
        start = self._grow({m: replace(s, max_depth=0) for m, s in enumerate(self.specs) if self.counts[m]}, -1)
        self.models = [QuantileBoostModel(self.features, s.alpha, float(start[m].value[0]) if m in start else float("nan"),
                                          s.learning_rate) for m, s in enumerate(self.specs)]
        for m, tree in start.items():
            self.since[m].append((1.0, tree))

    def _put(self, rows: DataFrame) -> None:
        """Write the table anew; the files before go, unless predictions that were given out read them.

        What does not fit in memory is read from the files again and not written to disk once more.
        """
        old, path, lent = getattr(self, "table", None), self.path, self.lent
        table, self.path = materialised(rows)
        self.table, self.lent = table.persist(StorageLevel.MEMORY_ONLY), False
        if old is not None:
            old.unpersist()
            if not lent:
                discard(self.spark, path)

    # -------------------------------------------------------------- one round
    def _scan(self, emit, schema: str) -> DataFrame:
        names, width, slots = self.names, len(self.features), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from emit(_arrays(b, names, width, slots) for b in batches if b.num_rows)

        return self.table.select(*vars(names).values()).mapInArrow(run, schema)

    def _in_groups(self, rows: DataFrame, groups: int, run, schema: str) -> list:
        parts = max(1, min(groups, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        return rows.repartition(parts, "m", "node").groupBy("m", "node").applyInArrow(run, schema).collect()

    def _training_rows(self, specs: dict):
        """Per batch and model: (model, bins, residual, weight) of the rows that the model learns from."""
        since, slots = {m: self.since[m] for m in specs}, {m: self.slots[m] for m in specs}

        def rows(batch):
            x, y, w, group, fold, pred = batch
            for m, s in specs.items():
                k = np.ones(len(y), dtype=bool) if s.group is None else group == s.group
                at = np.flatnonzero(k if s.fold is None else k & (fold != s.fold))
                if len(at):
                    xs = x[at]
                    yield m, xs, y[at] - _predicted(pred[at, slots[m]], xs, since[m]), w[at]

        return rows

    def _finish(self, specs: dict, trees: dict, small: dict, round_: int) -> list:
        """The subtrees under nodes of few rows, each grown by one task."""
        training, bins, width = self._training_rows({m: specs[m] for m in small}), self.bins, len(self.features)
        partial = {m: trees[m] for m in small}

        def emit(batches):
            for batch in batches:
                out = {"m": [], "node": [], "rows": []}
                for m, x, res, w in training(batch):
                    at = partial[m].nodes_of(x)
                    for node in small[m]:
                        k = at == node
                        if k.any():
                            out["m"].append(m)
                            out["node"].append(node)
                            out["rows"].append(np.ascontiguousarray(x[k]).tobytes() + res[k].tobytes() + w[k].tobytes())
                if out["m"]:
                    yield pa.RecordBatch.from_arrays([pa.array(out["m"], pa.int32()), pa.array(out["node"], pa.int64()),
                                                      pa.array(out["rows"], pa.binary())], names=list(out))

        def grow(t: pa.Table) -> pa.Table:
            m, node = t.column("m")[0].as_py(), t.column("node")[0].as_py()
            xs, rs, ws = [], [], []
            for data in t.column("rows").to_pylist():
                n = len(data) // (width + 16)
                xs.append(np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(-1, width))
                rs.append(np.frombuffer(data, count=n, offset=n * width))
                ws.append(np.frombuffer(data, count=n, offset=n * (width + 8)))
            key = int(partial[m].key[node])
            sub = grow_subtree(np.concatenate(xs), np.concatenate(rs), np.concatenate(ws), bins, specs[m], round_, key,
                               key.bit_length() - 1)
            return pa.table({"m": pa.array([m], pa.int32()), "node": pa.array([node], pa.int64()),
                             "tree": pa.array([sub.to_bytes()], pa.binary())})

        groups = sum(len(v) for v in small.values())
        return self._in_groups(self._scan(emit, "m int, node long, rows binary"), groups, grow, "m int, node long, tree binary")

    def _split(self, specs: dict, trees: dict, wide: dict, round_: int) -> list:
        """One step of the nodes of many rows: the split of a node, or the next bits of a leaf's quantile."""
        training, bins = self._training_rows({m: specs[m] for m in wide}), self.bins
        partial = {m: trees[m] for m in wide}
        offset = np.concatenate([[0], np.cumsum(bins)])
        width = int(offset[-1])

        def emit(batches):
            sums: dict = {}
            for batch in batches:
                for m, x, res, w in training(batch):
                    at = partial[m].nodes_of(x)
                    for node, leaf in wide[m].items():
                        k = at == node
                        if not k.any():
                            continue
                        if leaf is not None and specs[m].loss == "squared":
                            table = np.array([[k.sum()], [w[k].sum()], [(w[k] * res[k]).sum()]])
                        elif leaf is not None:
                            cell, weight = leaf.cells(res[k], w[k])
                            got = np.bincount(cell, weights=weight, minlength=1 << 16)
                            table = np.stack([got, got, got])
                        else:
                            table = np.zeros((3, width))
                            up = specs[m].gradient(res[k], w[k])
                            for j, b in enumerate(bins):
                                part = slice(offset[j], offset[j] + b)
                                for i, weight in enumerate((None, w[k], up)):
                                    table[i, part] = np.bincount(x[k, j], weights=weight, minlength=b)
                        sums[m, node] = sums[m, node] + table if (m, node) in sums else table
            for (m, node), table in sums.items():
                cell = np.flatnonzero(table[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), m), pa.int32()), pa.array(np.full(len(cell), node), pa.int64()),
                     pa.array(cell, pa.int32()), *[pa.array(v[cell], pa.float64()) for v in table]], names=["m", "node", "cell", "n", "w", "p"])

        def choose(t: pa.Table) -> pa.Table:
            m, node = t.column("m")[0].as_py(), t.column("node")[0].as_py()
            cell = t.column("cell").to_numpy()
            leaf = wide[m][node]
            if leaf is not None and specs[m].loss == "squared":
                got = (-1, -1, 0.0, 0.0, 0.0, -1, t.column("p")[0].as_py() / t.column("w")[0].as_py(), 0.0)
            elif leaf is not None:
                order = np.argsort(cell)
                leaf.choose(cell[order], t.column("w").to_numpy()[order], specs[m].alpha)
                got = (-1, -1, 0.0, 0.0, 0.0, leaf.prefix & 0xFFFF, leaf.below, leaf.total)
            else:
                dense = np.zeros((3, 1, width))
                for i, c in enumerate(("n", "w", "p")):
                    dense[i, 0, cell] = t.column(c).to_numpy()
                s = best_splits(*dense, bins, specs[m], round_, partial[m].key[[node]])
                got = (int(s.feature[0]), int(s.cut[0]), float(s.gain[0]), float(s.left[0]), float(s.right[0]), -1, 0.0, 0.0)
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.float64())
            names = ("feature", "cut", "gain", "left", "right", "digit", "below", "total")
            return pa.table({"m": pa.array([m], pa.int32()), "node": pa.array([node], pa.int64()),
                             **{c: pa.array([v], k) for c, v, k in zip(names, got, kinds)}})

        cells = self._scan(emit, "m int, node long, cell int, n double, w double, p double").groupBy("m", "node", "cell").agg(
            *[F.sum(c).alias(c) for c in "nwp"])
        return self._in_groups(cells, sum(len(v) for v in wide.values()), choose,
                               "m int, node long, feature int, cut int, gain double, left double, right double, "
                               "digit int, below double, total double")

    def _grow(self, specs: dict[int, Spec], round_: int) -> dict[int, Tree]:
        """One tree of each model."""
        trees = {m: Tree.root(self.counts[m]) for m in specs}
        small, wide = {m: [] for m in specs}, {m: {} for m in specs}

        def place(m: int, node: int) -> None:
            spec, count, depth = specs[m], trees[m].count[node], int(trees[m].key[node]).bit_length() - 1
            if count <= self.local_rows:
                small[m].append(node)
            elif depth < spec.max_depth and count >= max(2, spec.min_samples_split, 2 * spec.min_samples_leaf):
                wide[m][node] = None
            else:
                wide[m][node] = BigLeaf()

        for m in specs:
            place(m, 0)
        while any(wide.values()):
            for r in self._split(specs, trees, {m: v for m, v in wide.items() if v}, round_):
                m, node = r["m"], r["node"]
                leaf = wide[m].pop(node)
                if leaf is not None and r["digit"] < 0:
                    trees[m].value[node] = r["below"]
                elif leaf is not None:
                    leaf.prefix, leaf.bits = (leaf.prefix << 16) | r["digit"], leaf.bits + 16
                    leaf.below, leaf.total = r["below"], r["total"]
                    if leaf.bits == 64:
                        trees[m].value[node] = leaf.value
                    else:
                        wide[m][node] = leaf
                elif r["feature"] < 0:
                    wide[m][node] = BigLeaf()
                else:
                    for child in trees[m].split(node, r["feature"], r["cut"], r["gain"], r["left"], r["right"]):
                        place(m, child)
        small = {m: v for m, v in small.items() if v}
        if small:
            for r in self._finish(specs, trees, small, round_):
                trees[r["m"]].graft(r["node"], Tree.from_bytes(bytes(r["tree"])))
        return trees

    def _flat(self, t: Tree) -> FlatTree:
        threshold = [self.edges[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]
        return FlatTree(t.feature.astype(np.int64), np.array(threshold), t.left.astype(np.int64), t.right.astype(np.int64),
                        t.value, t.gain, t.count)

    def _add(self, m: int, tree: Tree) -> None:
        if self.keep_trees:
            self.models[m].trees.append(self._flat(tree))
        self.since[m].append((self.specs[m].learning_rate, tree))

    def _most_bytes(self, m: int) -> float:
        """Bytes of a tree of model ``m``, at most."""
        s = self.specs[m]
        return 2 * NODE_BYTES * min(2.0 ** s.max_depth, self.counts[m] / max(1, s.min_samples_leaf))

    def _grow_models(self, chosen: list[int], first: int, end: int) -> dict[int, float]:
        """The trees of the rounds ``first`` to ``end`` - 1 of models of few rows, each model grown by one task; bytes of a tree of each."""
        # The tasks of most work start first, so that none of them is left alone at the end.
        chosen = sorted(chosen, key=lambda m: -self.counts[m] * self.specs[m].max_depth * min(end - first, self.specs[m].n_estimators - first))
        specs, since, slots, bins, width = self.specs, self.since, self.slots, self.bins, len(self.features)

        def emit(batches):
            for x, y, w, group, fold, pred in batches:
                out = {"at": [], "rows": []}
                for i, m in enumerate(chosen):
                    s = specs[m]
                    k = np.ones(len(y), dtype=bool) if s.group is None else group == s.group
                    k = np.flatnonzero(k if s.fold is None else k & (fold != s.fold))
                    if len(k):
                        out["at"].append(i)
                        out["rows"].append(np.ascontiguousarray(x[k]).tobytes() + b"".join(
                            v.astype(np.float64).tobytes() for v in (y[k], _predicted(pred[k, slots[m]], x[k], since[m]), w[k])))
                if out["at"]:
                    yield pa.RecordBatch.from_arrays([pa.array(out["at"], pa.int32()), pa.array(out["rows"], pa.binary())], names=list(out))

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict = {}
            for b in batches:
                for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    n = len(data) // (width + 24)
                    parts.setdefault(i, []).append((np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(-1, width), *[
                        np.frombuffer(data, count=n, offset=n * (width + 8 * j)) for j in range(3)]))
            for i, got in parts.items():
                s = specs[chosen[i]]
                trees = grow_rounds(*map(np.concatenate, zip(*got)), bins, s, first, min(end, s.n_estimators))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chosen[i]] * len(trees), pa.int32()), pa.array(range(len(trees)), pa.int32()),
                     pa.array([t.to_bytes() for t in trees], pa.binary())], names=["m", "i", "tree"])

        rows = self._scan(emit, "at int, rows binary").repartitionById(len(chosen), F.col("at"))
        size: dict = {}
        for r in sorted(rows.mapInArrow(grow, "m int, i int, tree binary").collect(), key=lambda r: (r["m"], r["i"])):
            size.setdefault(r["m"], []).append(len(r["tree"]))
            self._add(r["m"], Tree.from_bytes(bytes(r["tree"])))
        self._rewrite()
        return {m: sum(v) / len(v) for m, v in size.items()}

    def advance(self, rounds: int, only: Sequence[int] | None = None, track_loss: bool = False) -> None:
        """Grow the models (of ``only``) until each has ``rounds`` trees, or as many as its settings say.

        A model that is left out once does not come back. ``track_loss`` notes
        the mean training loss after each round, at the cost of one more job.
        """
        chosen = range(len(self.specs)) if only is None else only
        last = min(rounds, max((self.specs[m].n_estimators for m in chosen if self.counts[m]), default=0))
        whole = [] if track_loss else [m for m in chosen if 0 < self.counts[m] <= WHOLE * self.local_rows]
        chosen, at = [m for m in chosen if m not in whole], self.rounds
        size = {m: self._most_bytes(m) for m in whole}
        while at < last and (active := [m for m in whole if at < self.specs[m].n_estimators]):
            most = min(TREES_A_JOB // len(active), int(TREE_BYTES_A_JOB / sum(size[m] for m in active)))
            end = min(last, at + max(1, most))
            size |= self._grow_models(active, at, end)
            at = end
        while self.rounds < rounds:
            active = {m: self.specs[m] for m in chosen if self.counts[m] and self.rounds < self.specs[m].n_estimators}
            if not active:
                break
            for m, tree in self._grow(active, self.rounds).items():
                self._add(m, tree)
            self.rounds += 1
            if self.rounds % self.rewrite_every == 0:
                self._rewrite()
            if max(self.counts) > WHOLE * LOCAL_ROWS:
                release(self.spark)  # a round deals out the rows of all small nodes: its shuffle files go before the next one's come
            if track_loss:
                for m, (train, _) in self.losses().items():
                    if m in active:
                        self.models[m].train_loss.append(train)
        self.rounds = max(self.rounds, last)

    def _rewrite(self) -> None:
        """Write the table with the predictions of all trees grown so far."""
        names, width, since, slots, n = self.names, len(self.features), self.since, list(enumerate(self.slots)), self.width
        specs = self.specs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x, _, _, group, _, pred = _arrays(b, names, width, n)
                    now = pred.copy()
                    for m, slot in slots:
                        if since[m]:
                            k = slice(None) if specs[m].group is None else np.flatnonzero(group == specs[m].group)
                            if specs[m].group is None or len(k):
                                now[k, slot] = _predicted(pred[k, slot], x[k], since[m])
                    at = b.schema.get_field_index(names.pred)
                    cells = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n, pa.int32()), pa.array(now.ravel()))
                    yield b.set_column(at, names.pred, cells)

        self._put(self.table.mapInArrow(run, self.table.schema))
        self.since = [[] for _ in self.specs]

    # -------------------------------------------------------------- results
    def losses(self, absolute: bool = False) -> dict[int, tuple[float, float]]:
        """Per model the mean loss over the rows that it learns from and over its own fold (NaN without rows).

        ``absolute`` takes the absolute error for the loss, without weights.
        """
        since, specs, slots = self.since, self.specs, self.slots

        def emit(batches):
            sums = np.zeros((len(specs), 4))
            for x, y, w, group, fold, pred in batches:
                for m, s in enumerate(specs):
                    k = np.flatnonzero(np.ones(len(y), dtype=bool) if s.group is None else group == s.group)
                    e = y[k] - _predicted(pred[k, slots[m]], x[k], since[m])
                    own = np.zeros(len(k), dtype=bool) if s.fold is None else fold[k] == s.fold
                    v = np.ones(len(k)) if absolute else w[k]
                    loss = np.abs(e) if absolute else v * (
                        e * e if s.loss == "squared" else np.where(e >= 0, s.alpha * e, (s.alpha - 1) * e))
                    sums[m] += loss[~own].sum(), v[~own].sum(), loss[own].sum(), v[own].sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(specs)), pa.int32()), *[pa.array(c) for c in sums.T]],
                                             names=["m", "a", "b", "c", "d"])

        rows = self._scan(emit, "m int, a double, b double, c double, d double").groupBy("m").agg(
            F.sum("a"), F.sum("b"), F.sum("c"), F.sum("d")).collect()
        part = lambda s, n: s / n if n else float("nan")
        return {r[0]: (part(r[1], r[2]), part(r[3], r[4])) for r in rows}

    def predictions(self) -> DataFrame:
        """The rows as (keep, y_true, weight, group, fold, pred: a prediction for each slot), after the trees grown so far."""
        if any(self.since):
            self._rewrite()
        n, self.lent = self.names, True
        return self.table.select(*self.keep, F.col(n.y).alias("y_true"), F.col(n.w).alias("weight"),
                                 *[F.when(F.col(c) >= 0, F.col(c)).alias(a) for c, a in ((n.group, "group"), (n.fold, "fold"))],
                                 F.col(n.pred).alias("pred"))

    def close(self) -> None:
        self.table.unpersist()
        if not self.lent:
            discard(self.spark, self.path)


# ------------------------------------------------------------------ single models and intervals
def fit_quantile_boost(df: DataFrame, features: list, label: str, alpha: float, n_estimators: int = 100,
                       max_depth: int = 3, min_samples_leaf: int = 1, min_samples_split: int = 2,
                       learning_rate: float = 0.1, seed: int = 42, max_bins: int = MAX_BINS, weight_col: str | None = None,
                       node_features: int | None = None, track_loss: bool = False, **batch) -> QuantileBoostModel:
    """Fit one quantile (pinball-loss) boosting model on a Spark DataFrame.

    ``track_loss`` records the training pinball loss after each round.
    """
    spec = Spec(alpha, n_estimators, max_depth, min_samples_leaf, min_samples_split, learning_rate, None, node_features, seed)
    b = BoostBatch(df, features, label, [spec], weight_col=weight_col, max_bins=max_bins, **batch)
    b.advance(n_estimators, track_loss=track_loss)
    b.close()
    return b.models[0]


def spec_of(alpha: float, params: dict, fold: int | None = None, seed: int = 42, n_estimators: int | None = None) -> Spec:
    """Settings in the source's naming (n_estimators, min_samples_leaf, min_samples_split, learning_rate, max_depth)."""
    return Spec(alpha, n_estimators or params["n_estimators"], params["max_depth"], params["min_samples_leaf"],
                params["min_samples_split"], params["learning_rate"], fold, None, seed)


def interval_batch(df: DataFrame, features: list, label: str, lower_alpha: float, upper_alpha: float, lower_params: dict,
                   upper_params: dict, seed: int = 42, n_estimators: int | None = None, keep: Sequence[str] = (),
                   fold_col: str | None = None, folds: Sequence[int | None] = (None,)) -> BoostBatch:
    """Lower and upper models (for each fold left out), grown to their rounds in the same jobs; models 2i and 2i + 1 leave out folds[i]."""
    specs = [spec_of(a, p, f, seed, n_estimators) for f in folds for a, p in ((lower_alpha, lower_params), (upper_alpha, upper_params))]
    b = BoostBatch(df, features, label, specs, keep, fold_col)
    b.advance(max(s.n_estimators for s in specs))
    return b


def fit_interval(df: DataFrame, features: list, label: str, lower_alpha: float, upper_alpha: float,
                 lower_params: dict, upper_params: dict, seed: int = 42, n_estimators: int | None = None):
    """Lower and upper quantile models with per-bound settings."""
    b = interval_batch(df, features, label, lower_alpha, upper_alpha, lower_params, upper_params, seed, n_estimators)
    b.close()
    return b.models[0], b.models[1]


def predictions_table(df: DataFrame, lower: QuantileBoostModel, upper: QuantileBoostModel, label: str,
                      keep: list) -> DataFrame:
    """Rows with ``y_true``, ``y_pred_lower``, ``y_pred_upper`` (the predictions table)."""
    out = lower.transform(df, "y_pred_lower")
    out = upper.transform(out, "y_pred_upper")
    return out.select(*keep, F.col(label).cast("double").alias("y_true"), "y_pred_lower", "y_pred_upper")
