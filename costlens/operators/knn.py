"""Exact k-nearest-neighbour mean over scaled features, without broadcasting either side.

The features are standardised with the data's mean and deviation. A tree of
median splits over the widest features, built from a bounded sample, cuts the
data into leaves; every leaf's box spans all its rows, and a leaf of many rows
(a hot value) is dealt into blocks. Pass 1 finds each query's k nearest rows in
its own leaf, whose last distance bounds the true one. Pass 2 sends the query
only to the other leaves whose box is within that bound. The union of both
passes holds the k nearest rows.

The distance depends on the feature values alone, so equal queries are asked
once, and of equal data rows only the k first by id are kept. Ties in distance
(to nine decimals) go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.operators.ranking import free_names
from costlens.plans.materialise import materialise

# Data rows of a leaf, about, and of a block at most, about; rows that the splits are chosen from.
LEAF_ROWS, BLOCK_ROWS, SAMPLE = 256, 4096, 50_000
# A leaf has this many sampled rows at least.
LEAF_SAMPLE = 8
_FOUND = "q long, id long, value double, dist double"


def build_tree(x: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, first child or minus the leaf's number minus 1) of median splits until leaves have ``leaf_rows`` rows."""
    feature, cut, child = [0], [0.0], [0]
    leaves, todo = 0, [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        part = x[rows]
        for f in np.argsort(-part.var(axis=0), kind="stable") if len(rows) > leaf_rows else ():
            at = float(np.median(part[:, f]))
            left = part[:, f] <= at
            if left.all():  # most rows are at the top: cut below it
                at = float(part[part[:, f] < at, f].max()) if (part[:, f] < at).any() else at
                left = part[:, f] <= at
            if left.any() and not left.all():
                feature[node], cut[node], child[node] = int(f), at, len(feature)
                for side in (left, ~left):
                    todo.append((len(feature), rows[side]))
                    feature.append(0)
                    cut.append(0.0)
                    child.append(0)
                break
        else:
            leaves += 1
            child[node] = -leaves
    return np.array(feature), np.array(cut), np.array(child)


def leaves_of(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Leaf number of each row."""
    feature, cut, child = tree
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        go = np.flatnonzero(child[at] > 0)
        if not len(go):
            return -child[at] - 1
        node = at[go]
        at[go] = child[node] + (x[go, feature[node]] > cut[node])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _with_leaf(rows: DataFrame, tree) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(leaf=leaves_of(_matrix(f["x"]), tree).astype(np.int32))

    return rows.mapInPandas(run, ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in rows.schema) + ", leaf int")


def _within_reach(low: np.ndarray, high: np.ndarray):
    """The leaves other than its own whose box a query's bound reaches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 64):
                g = f.iloc[at:at + 64]
                x = _matrix(g["x"])
                apart = np.zeros((len(g), len(low)))
                for j in range(x.shape[1]):
                    apart += np.maximum(0, np.maximum(low[None, :, j] - x[:, j:j + 1], x[:, j:j + 1] - high[None, :, j])) ** 2
                near = np.sqrt(apart) <= g["r"].to_numpy()[:, None]
                near[np.arange(len(g)), g["leaf"].to_numpy()] = False
                i, leaf = np.nonzero(near)
                yield pd.DataFrame({"id": g["id"].to_numpy()[i], "x": g["x"].to_numpy()[i], "leaf": leaf.astype(np.int32)})

    return run


def _nearest(k: int):
    """Nearest data rows of each query in blocks that come sorted, data rows (ask = 0) before the queries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, held, data = None, [], None
        for f in frames:
            for s, g in f.groupby(["leaf", "block"], sort=False):
                if s != piece:
                    piece, held, data = s, [], None
                rows, asks = g[g["ask"] == 0], g[g["ask"] == 1]
                if len(rows):
                    held.append(rows)
                if not len(asks) or not held:
                    continue
                if data is None:
                    d = pd.concat(held)
                    data = _matrix(d["x"]), d["id"].to_numpy(), d["value"].to_numpy()
                x, ids, values = data
                for at in range(0, len(asks), 128):
                    a = asks.iloc[at:at + 128]
                    ask = _matrix(a["x"])
                    dist = np.zeros((len(a), len(x)))
                    for j in range(x.shape[1]):
                        dist += (ask[:, j:j + 1] - x[None, :, j]) ** 2
                    dist = np.round(dist, 9)
                    last = np.partition(dist, k - 1, axis=1)[:, k - 1:k] if len(x) > k else dist.max(axis=1, keepdims=True)
                    i, j = np.nonzero(dist <= last)
                    order = np.lexsort((ids[j], dist[i, j], i))
                    i, j = i[order], j[order]
                    first = np.arange(len(i)) - np.searchsorted(i, i) < k
                    i, j = i[first], j[first]
                    yield pd.DataFrame({"q": a["id"].to_numpy()[i], "id": ids[j], "value": values[j], "dist": dist[i, j]})

    return run


def _ask(data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    both = data.select("leaf", "block", F.lit(0).alias("ask"), "id", "x", "value").unionByName(
        queries.select("leaf", "block", F.lit(1).alias("ask"), "id", "x", F.lit(None).cast("double").alias("value")))
    both = both.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "ask", "id")
    return both.mapInPandas(_nearest(k), _FOUND)


def knn_mean(query: DataFrame, data: DataFrame, features: Sequence[str], value: str, key: str, k: int = 5,
             out: str = "knn_mean", leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE) -> DataFrame:
    """Add the mean ``value`` of the k nearest ``data`` rows to every ``query`` row.

    ``key`` is the data's integer id. Data rows with a null feature, value or
    id are left out; a query row with a null feature gets null, and with
    fewer than k data rows the mean is over all of them. Other columns of the
    query may have any names.
    """
    features = list(features)
    base = data.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(value).cast("double").alias("value"),
                       F.col(key).cast("long").alias("id")).na.drop()
    stats = base.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    if not stats["n"]:
        return query.withColumn(out, F.lit(None).cast("double"))
    scaled = [((F.col(c).cast("double") - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)) for i, c in enumerate(features)]

    first = Window.partitionBy(*features).orderBy("id")
    rows = base.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k)
    rows = rows.select("id", "value", F.array(*scaled).alias("x"))
    cells = query.select(*[F.col(c).cast("double").alias(c) for c in features]).na.drop().distinct()
    cells = cells.select(*features, F.array(*scaled).alias("x"), F.xxhash64(*features).alias("id"))

    rows = materialise(rows)
    n = rows.count()
    drawn = _matrix(rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("x").toPandas()["x"])
    tree = build_tree(drawn, max(1, LEAF_SAMPLE if n > len(drawn) else 1, round(leaf_rows * len(drawn) / n)))
    rows, cells = materialise(_with_leaf(rows, tree)), _with_leaf(cells, tree)
    width = range(len(features))
    at = [F.get("x", F.lit(i)) for i in width]
    boxes = rows.groupBy("leaf").agg(F.count("*").alias("n"), F.array(*[F.min(c) for c in at]).alias("low"),
                                     F.array(*[F.max(c) for c in at]).alias("high")).orderBy("leaf").collect()  # sample rows at most
    low, high = np.full((len(boxes), len(features)), np.inf), np.full((len(boxes), len(features)), -np.inf)
    pieces = [1] * len(boxes)
    for b in boxes:
        low[b["leaf"]], high[b["leaf"]], pieces[b["leaf"]] = b["low"], b["high"], -(-b["n"] // block_rows)
    blocks = F.get(F.lit(pieces), F.col("leaf"))
    rows = materialise(rows.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")))
    every = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    cells = materialise(cells.select("id", "x", "leaf"))
    own = materialise(_ask(rows, cells.select("*", every), k))
    found = own.groupBy("q", "id", "value").agg(F.min("dist").alias("dist"))
    place = Window.partitionBy("q").orderBy("dist", "id")
    reach = found.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).groupBy("q").agg(
        F.count("*").alias("_found"), F.max("dist").alias("_d"))
    far = cells.join(reach, F.col("id") == F.col("q"), "left").select("id", "x", "leaf", F.when(
        F.col("_found") >= k, F.sqrt("_d") + 1e-6).otherwise(F.lit(float("inf"))).alias("r"))
    kind = far.schema["x"].dataType.simpleString()
    others = materialise(far.mapInPandas(_within_reach(low, high), f"id long, x {kind}, leaf int"))
    found = own.unionByName(_ask(rows, others.select("*", every), k))
    best = Window.partitionBy("q").orderBy("dist", "id")
    means = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).groupBy("q").agg(F.avg("value").alias(out))
    hashed = F.xxhash64(*[F.col(c).cast("double") for c in features])
    none = F.lit(False)
    for c in features:
        none = none | F.col(c).isNull()
    name, match = free_names([*query.columns, out], "_q", "_match")
    means = means.withColumnRenamed("q", match)
    return query.withColumn(name, F.when(~none, hashed)).join(means, F.col(name) == F.col(match), "left").drop(name, match)
