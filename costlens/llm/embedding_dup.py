"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the centred, length-1 vectors is learned on a bounded sample
so that the signs of the rotated coordinates are balanced and lose little;
they are the binary code. (How far to centre is set by the recall measured on
the sample.) The code is cut into parts of ``PART`` bits, one
table each. Two codes that differ in fewer than ``2 * tables`` bits agree in some
part but for one bit, so every vector looks up its own part and all parts one
bit away in every table. What it meets there with the same label is compared
by cosine on the original vectors in double precision.

Equal vectors of a label are one class with a count. A bucket is worked on in
blocks of stored and asking vectors as matrix products; a pair met in several
tables counts in the first, which both codes tell. Only counts and spanning
links leave a task, so a hot bucket makes no pairs.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import stash
from costlens.llm.components import connected_components

SAMPLE = 8192
BITS, PART = 64, 16
# Share of the hardest pairs that the tables must bring together on the sample.
RECALL = 0.98
STORED, ASKING = 2048, 8192
# Buckets of more pairs than LARGE are matrix products of their own; those of others go PAIRS at a time.
LARGE, PAIRS = 20_000, 40_000
_MET = "u long, v long, k long, n long"


def learn_rotation(v: np.ndarray, bits: int, rounds: int = 30, seed: int = 3) -> np.ndarray:
    """Projection (dimensions x bits) of the sample rows v by iterative quantisation.

    Vectors of fewer dimensions than bits get several rotations side by side.
    """
    _, axes = np.linalg.eigh(v.T @ v)
    axes = axes[:, ::-1][:, :min(bits, v.shape[1])]
    x, parts = v @ axes, []
    while sum(p.shape[1] for p in parts) < bits:
        n = x.shape[1]
        r = np.linalg.qr(np.random.default_rng(seed + len(parts)).normal(size=(n, n)))[0]
        for _ in range(rounds if len(v) else 0):
            left, _, right = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0))
            r = left @ right
        parts.append(axes @ r)
    return np.concatenate(parts, axis=1)[:, :bits]


def fit_codes(x: np.ndarray, threshold: float, bits: int = BITS, part: int = PART) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, projection and measured recall of the tables for the length-1 sample rows x.

    Subtracting the mean balances the bits, but it widens the angle between
    neighbours that lie close to the mean. So the largest share of the mean
    is taken off at which sample vectors still meet vectors at exactly the
    threshold, the hardest ones to find.
    """
    rng = np.random.default_rng(9)
    if not len(x):
        return np.zeros(x.shape[1]), learn_rotation(x, bits), 1.0
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    near = threshold * x + np.sqrt(1 - threshold ** 2) * noise / np.maximum(length, 1e-12)
    tried = []
    for share in (1.0, 0.5, 0.0):
        centre = share * x.mean(axis=0)
        projection = learn_rotation(x - centre, bits)
        a, b = codes(x, centre, projection), codes(near, centre, projection)
        tables = -(-bits // part)
        found = ~_first_met(a, b, tables, tables, part)
        tried.append((float(found.mean()), centre, projection))
        if tried[-1][0] >= RECALL:
            break
    recall, centre, projection = max(tried, key=lambda t: min(t[0], RECALL))
    return centre, projection, recall


def fit_tables(x: np.ndarray, threshold: float, part: int = PART) -> tuple[np.ndarray, np.ndarray, int]:
    """Centre, projection and bits of a table: the largest tables of at most ``part`` bits that reach the recall.

    Narrower tables bring more pairs together, at more work. If no width
    reaches RECALL on the sample, a warning says so and the best is taken.
    """
    tried = []
    for bits in dict.fromkeys((part, *(b for b in (12, 8, 4) if b < part))):
        centre, projection, recall = fit_codes(x, threshold, BITS, bits)
        tried.append((recall, bits, centre, projection))
        if recall >= RECALL:
            break
    recall, bits, centre, projection = max(tried, key=lambda t: (min(t[0], RECALL), t[1]))
    if recall < RECALL:
        warnings.warn(f"tables of {bits} bits reach a recall of {recall:.3f} on the sample, under {RECALL}", stacklevel=2)
    return centre, projection, bits


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """64-bit code of each row; bits beyond the projection's are 0."""
    on = ((x - mean) @ projection >= 0).astype(np.uint64)
    return (on << np.arange(on.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _matrix(vectors, width: int) -> np.ndarray:
    """Length-1 rows, padded with zeros to the width."""
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _first_met(a: np.ndarray, b: np.ndarray, table, tables: int, part: int) -> np.ndarray:
    """Whether no table before ``table`` (a number, or one for each pair) brings the two codes together."""
    out, mask = np.ones(len(a), dtype=bool), np.uint64((1 << part) - 1)
    for t in range(tables):
        out &= (t >= table) | (np.bitwise_count(((a ^ b) >> np.uint64(t * part)) & mask) > 1)
    return out


def _spread(label: np.ndarray, i: np.ndarray, j: np.ndarray, asking: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the stored rows after asking row i ties the stored rows j it links; least label of each asking row."""
    while True:
        low = np.full(asking, len(label))
        np.minimum.at(low, i, label[j])
        new = label.copy()
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == label).all():
            return label, low
        label = new


def _compare(threshold: float, tables: int, part: int):
    """Links of buckets that come sorted, their stored rows before the asking ones."""
    bucket = ["label", "tab", "part", "sb", "qb"]

    def pairs(at, first, count):
        """Asking rows ``at``, each with the ``count`` stored rows from ``first`` on, in chunks."""
        total = np.cumsum(count)
        cuts = np.unique(np.searchsorted(total, np.arange(PAIRS, total[-1] + PAIRS, PAIRS), side="left") + 1)
        lo = 0
        for hi in cuts:
            c = count[lo:hi]
            if c.sum():
                i = np.repeat(at[lo:hi], c)
                yield i, np.repeat(first[lo:hi] - np.cumsum(c) + c, c) + np.arange(c.sum())
            lo = hi

    def work(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ids, keys, copies, tab = (f[c].to_numpy() for c in ("rep", "key", "copies", "tab"))
        code, asks = f["code"].to_numpy().view(np.uint64), f["asks"].to_numpy()
        vec = np.frombuffer(b"".join(f["vec"])).reshape(len(f), -1)  # padded to one width
        run = f.groupby(bucket, sort=False).ngroup().to_numpy()
        start = np.flatnonzero(np.diff(run, prepend=-1))
        stored = np.add.reduceat((~asks).astype(np.int64), start)
        asking = np.add.reduceat(asks.astype(np.int64), start)
        large = stored * asking > LARGE

        def links(i, j, cosine):
            ok = (cosine >= threshold) & ((ids[i] != ids[j]) | (keys[i] != keys[j]))
            i, j = i[ok], j[ok]
            ok = _first_met(code[i], code[j], tab[i], tables, part)
            return i[ok], j[ok]

        def found(i, j, label):
            """Counts and a tie of each asking row, its ties spread over the labels of the stored rows."""
            label, low = _spread(label, i, j, len(f))
            hit = np.unique(i)
            n = np.bincount(i, weights=copies[j], minlength=len(f)).astype(np.int64)
            return label, pd.DataFrame({"u": ids[hit], "v": ids[low[hit]], "k": keys[hit], "n": n[hit]})

        def tied(label):
            out = np.flatnonzero(label != np.arange(len(label)))
            return pd.DataFrame({"u": ids[out], "v": ids[label[out]], "k": keys[out], "n": 0})

        at = np.flatnonzero(asks & ~large[run])
        label = np.arange(len(f))
        if len(at):
            got = [links(i, j, np.einsum("ij,ij->i", vec[i], vec[j])) for i, j in pairs(at, start[run[at]], stored[run[at]])]
            i, j = (np.concatenate(x) for x in zip(*got)) if got else (at[:0], at[:0])
            if len(i):
                label, out = found(i, j, label)
                yield out
        for r in np.flatnonzero(large):
            own = np.arange(start[r], start[r] + stored[r])
            for a in range(start[r] + stored[r], start[r] + stored[r] + asking[r], 1024):
                q = np.arange(a, min(a + 1024, start[r] + stored[r] + asking[r]))
                # The product may part from the sum over a pair in the last bits, so pairs near the bound are summed one by one.
                x, y = np.nonzero(vec[q] @ vec[own].T >= threshold - 1e-9)
                got = [links(q[x[a]], own[y[a]], np.einsum("ij,ij->i", vec[q[x[a]]], vec[own[y[a]]]))
                       for a in np.array_split(np.arange(len(x)), max(1, len(x) // PAIRS))]
                i, j = (np.concatenate(z) for z in zip(*got))
                if len(i):
                    label, out = found(i, j, label)
                    yield out
        yield tied(label)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            last = f[bucket].iloc[-1]
            same = (f[bucket] == last).all(axis=1).to_numpy()
            cut = int(np.flatnonzero(same)[0])  # the last bucket may go on
            if cut:
                yield from work(f.iloc[:cut].reset_index(drop=True))
            held = f.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield from work(held)

    return run


def near_embeddings(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, sample: int = SAMPLE, part: int = PART) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Links are pairs of equal, non-null label and equal length whose cosine
    in double precision is at least ``threshold``. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing.
    Repeated rows and equal vectors link with each other. A row with a null
    id links with nothing, has a null component and is kept. The rotation is
    learned on ``sample`` vectors at most; all vectors are indexed. Other
    columns are left out; an empty table gives no rows.
    """
    spark = rows.sparkSession
    e = F.col("e")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("e"),
                       F.col(label_col).cast("string").alias("label"))
    base = base.withColumn("ok", F.coalesce((F.size(e) > 0) & sound & F.exists(e, lambda x: x != 0), F.lit(False)))
    # Zeros of either sign are one value.
    base = base.withColumn("e", F.transform(e, lambda x: x + F.lit(0.0)))
    able = F.col("ok") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    keys = base.withColumn("key", F.when(able, F.xxhash64("e"))).withColumn("key2", F.when(able, F.xxhash64(F.lit(1), "e")))
    classes = keys.where("key is not null").groupBy("label", "key", "key2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("e").alias("e"))

    classes = stash(classes, "classes")
    drawn = classes.select("e", F.xxhash64("key", "rep").alias("h")).orderBy("h").limit(sample).collect()
    width = classes.agg(F.max(F.size("e"))).first()[0] or 1
    mean, projection, part = fit_tables(_matrix([r["e"] for r in drawn], width), threshold, part)
    tables = -(-projection.shape[1] // part)
    model = spark.sparkContext.broadcast((mean, projection))  # width * BITS numbers

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, p = model.value
        for f in frames:
            x = _matrix(f.pop("e"), width)
            f["code"] = codes(x, m, p).view(np.int64)
            f["vec"] = [v.tobytes() for v in x]
            yield f

    # The vectors' length is part of the label, so that only equal lengths meet.
    coded = classes.select(F.concat_ws(":", F.size("e").cast("string"), "label").alias("label"),
                           F.col("label").alias("given"), "key", "key2", "rep", "copies", "e")
    coded = stash(coded.mapInPandas(encode, "label string, given string, key long, key2 long, rep long, copies long, code long, vec binary"), "codes")

    def lookups(radius: bool):
        at = lambda t: F.shiftright("code", t * part).bitwiseAND(F.lit((1 << part) - 1)).cast("int")
        flips = [0, *(1 << i for i in range(part))] if radius else [0]
        return F.explode(F.flatten(F.array(*[F.array(*[F.struct(
            F.lit(t).alias("tab"), at(t).bitwiseXOR(F.lit(x)).alias("part")) for x in flips]) for t in range(tables)])))

    small = coded.select("label", "rep", "key", "code")
    stored = small.select("label", "rep", "key", lookups(False).alias("b")).select("label", "rep", "key", "b.*")
    there = stored.groupBy("label", "tab", "part").agg(F.count("*").alias("n_stored"), F.min("rep").alias("one"),
                                                       F.min("key").alias("one_key"))
    asks = small.select("label", "rep", "key", lookups(True).alias("b")).select("label", "rep", "key", "b.*")
    on = ["label", "tab", "part"]
    # Only buckets that hold someone else are asked.
    asks = asks.join(there, on).where("n_stored > 1 or one <> rep or one_key <> key").drop("one", "one_key")
    asks = stash(asks, "asks")
    sizes = asks.groupBy(*on).agg(F.count("*").alias("n_asking"), F.first("n_stored").alias("n_stored"))
    blocks = lambda col, size: F.ceil(F.col(col) / size).cast("int")
    sizes = stash(sizes.select(*on, blocks("n_asking", ASKING).alias("qbs"), blocks("n_stored", STORED).alias("sbs")), "sizes")
    mine = lambda n: F.pmod(F.xxhash64("rep", "key"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask_rows = asks.join(sizes, on).withColumn("qb", mine(F.col("qbs"))).withColumn("sb", every("sbs"))
    kept_rows = stored.join(sizes, on).withColumn("sb", mine(F.col("sbs"))).withColumn("qb", every("qbs"))
    cols = [*on, "sb", "qb", "rep", "key"]
    vectors = coded.select("label", "rep", "key", "code", "copies", "vec")
    met = ask_rows.select(*cols, F.lit(True).alias("asks")).unionByName(
        kept_rows.select(*cols, F.lit(False).alias("asks"))).join(vectors, ["label", "rep", "key"])
    place = [*on, "sb", "qb"]
    met = met.repartition(*place).sortWithinPartitions(*place, "asks")
    found = stash(met.mapInPandas(_compare(threshold, tables, part), _MET), "links")

    comps = connected_components(found.select("u", "v"))
    counts = found.groupBy(F.col("u").alias("rep"), F.col("k").alias("key")).agg(F.sum("n").alias("n"))
    result = coded.select("given", "key", "key2", "rep", "copies").join(counts, ["rep", "key"], "left").join(
        comps, F.col("rep") == F.col("node"), "left").select(
        F.col("given").alias("label"), "key", "key2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "rep").alias("component"))
    out = keys.select("vec_id", "label", "key", "key2").join(result, ["label", "key", "key2"], "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
                      F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
