"""Near-duplicate documents: circulant MinHash candidates, exact Jaccard links, connected components.

Signature. Two permutations of the 32-bit universe serve all coordinates:
every shingle is permuted once by the first; coordinate k is the minimum
over the set of the second permutation applied to that value shifted back by
k, that is, of one permutation shifted around the circle.

Plan. Texts with equal shingle sets are one class. Classes that share a band
of the signature are tied to the smallest class of the bucket; the connected
components of those ties are candidate groups, each holding every pair that
shares a band. Within a group all pairs are checked exactly on the full sets,
as blocked products of binary matrices: a group is cut into blocks of bounded
size and every pair of blocks is a task's work of its own, so a hot group is
spread. Only spanning links leave a task, never the pairs of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import broadcast_small, stash
from costlens.llm.components import connected_components
from costlens.llm.shingles import mix, shingle_set

# 40 bands of 6 coordinates: a pair of similarity 0.85 shares no band with
# probability (1 - 0.85 ** 6) ** 40 = 6e-9, one of 0.8 with 5e-6.
BANDS, ROWS = 40, 6
# Shingles of a block; a document counts as FLOOR shingles at least, so a block has at most BLOCK / FLOOR documents.
BLOCK, FLOOR = 250_000, 500
_COLUMNS = 4096


def signature(shingles: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """n circulant MinHash coordinates of a non-empty set of 64-bit shingles."""
    first = (mix(shingles) >> np.uint64(32)).astype(np.uint32)
    shift = np.arange(n, dtype=np.uint32)
    least = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(first), 256):
        x = first[at:at + 256, None] - shift[None, :]  # modulo 2 ** 32
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of the signature."""
    parts = sig.reshape(bands, -1).astype(np.uint64)
    key = mix(np.arange(1, bands + 1, dtype=np.uint64))
    for j in range(parts.shape[1]):
        key = mix(key ^ (parts[:, j] + np.uint64(0x9E3779B97F4A7C15)))
    return key.view(np.int64)


def _sliced(frames: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """Smaller frames, so that the sets of few texts are held at a time."""
    for f in frames:
        for at in range(0, len(f), rows):
            yield f.iloc[at:at + rows]


def _digest(shingles: np.ndarray) -> bytes | None:
    """Digest of a shingle set; None for the empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of distinct shingles, digest of the set and band keys (both null without words)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _sliced(frames):
            sets = [shingle_set(t) for t in f["text"]]
            yield pd.DataFrame({
                "id": f["id"].astype("Int64"), "n_shingles": [len(s) for s in sets],
                "set_hash": [_digest(s) for s in sets],
                "bands": [band_keys(signature(s)) if len(s) else None for s in sets]})

    cols = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return cols.mapInPandas(run, "id long, n_shingles long, set_hash binary, bands array<long>")


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the least index it reaches by links within the list."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * both >= percent * (size.sum() - both) else 1])
    owner = np.repeat(np.arange(n), size)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), dtype=np.float32)  # counts below 2 ** 24 are exact; larger sets are summed in chunks
    width = int(column[-1]) + 1 if len(column) else 0
    total = np.zeros((n, n), dtype=np.int64) if width >= 1 << 24 else None
    for lo in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + _COLUMNS])
        part = np.zeros((n, min(_COLUMNS, width - lo)), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        if total is None:
            both += part @ part.T
        else:
            total += (part @ part.T).astype(np.int64)
    inter = both.astype(np.int64) if total is None else total
    link = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(link, label[None, :], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link_blocks(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last, ids, sets = None, None, [], []

        def links():
            if len(sets) < 2:
                return None
            order = np.argsort(ids, kind="stable")
            name = np.array(ids)[order]
            label = _linked([sets[i] for i in order], percent)
            out = name != name[label]
            return pd.DataFrame({"u": name[out], "v": name[label][out]})

        for f in frames:
            for k, i, d, s in zip(zip(f["root"], f["lo"], f["hi"]), f["rep"], f["set_hash"], f["shingles"]):
                if k != key:
                    if (got := links()) is not None:
                        yield got
                    key, last, ids, sets = k, None, [], []
                if d == last:  # the same class from another task
                    continue
                last = d
                ids.append(i)
                sets.append(np.frombuffer(s, dtype=np.uint64))
        if (got := links()) is not None:
            yield got

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` on their
    5-word shingle sets. Null texts and texts without words have no shingles
    and link with nothing. Repeated rows of an id are each returned, and the
    id is linked if any of its texts is. A row with a null id has a null
    component and is kept. Other columns are left out; an empty table gives
    no rows.
    """
    return _components(docs, id_col, text_col, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _components(docs, id_col, text_col, percent):
    rows = stash(sketch(docs, id_col, text_col), "sketch")
    named = rows.where("id is not null and set_hash is not null")
    classes = stash(named.groupBy("set_hash").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n"),
                                                  F.first("bands").alias("bands")), "classes")
    # Ties of each bucket with several classes to its smallest class. Two classes of one node would only widen a group.
    node = F.xxhash64("set_hash").alias("node")
    keys = classes.select(node, F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("last > head")
    ties = keys.join(heads.select("key", "head"), "key").where("node <> head").select("node", "head").distinct()
    groups = connected_components(ties, "node", "head").select("node", F.col("component").alias("root"))
    groups = stash(groups.join(classes.select(node, "set_hash", "rep", "n"), "node"), "groups")

    weight = groups.groupBy("root").agg(F.sum(F.greatest("n", F.lit(FLOOR))).alias("w"))
    weight = weight.select("root", F.ceil(F.col("w") / BLOCK).cast("int").alias("blocks"))
    place = stash(groups.join(weight, "root").select(
        "set_hash", "rep", "root", "blocks", F.pmod("node", "blocks").cast("int").alias("block")), "places")
    reps = broadcast_small(stash(place.select(F.col("rep").alias("id")).distinct(), "representatives"))
    place = broadcast_small(place)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A task sends a set once, however many rows hold it.
        sent = {None}
        for f in _sliced(frames):
            out = {}
            for t in f["text"]:
                s = shingle_set(t)
                if (d := _digest(s)) not in sent:
                    sent.add(d)
                    out[d] = s.tobytes()
            if out:
                yield pd.DataFrame({"set_hash": list(out), "shingles": list(out.values())})

    found = texts.where("text is not null").join(reps, "id", "left_semi").select("text").mapInPandas(
        sets, "set_hash binary, shingles binary").join(place, "set_hash")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi")))
    # Two blocks of a group meet in one task; a block alone is checked with any other.
    pair = F.when(F.col("blocks") > 1, F.filter(pair, lambda p: p["lo"] < p["hi"])).otherwise(pair)
    met = found.select("rep", "set_hash", "root", F.explode(pair).alias("p"), "shingles").select(
        "rep", "set_hash", "root", "p.lo", "p.hi", "shingles")
    met = met.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "rep", "set_hash")
    links = met.mapInPandas(_link_blocks(percent), "u long, v long")
    # An id with several texts ties their classes.
    several = named.groupBy("id").agg(F.min("set_hash").alias("a"), F.max("set_hash").alias("b")).where("a <> b").select("id")
    also = named.join(several, "id").join(classes.select("set_hash", "rep"), "set_hash").select(
        F.col("id").alias("u"), F.col("rep").alias("v"))
    linked = connected_components(links.unionByName(also))
    comp = classes.select("set_hash", "rep").join(linked, F.col("rep") == F.col("node"), "left").select(
        "set_hash", F.coalesce("component", "rep").alias("component"))
    out = rows.join(comp, "set_hash", "left")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = 80) -> DataFrame:
    """One row of each component, with all columns of ``docs``; rows with a null id stay.

    The smallest id stays; of repeated rows of that id, one: of several texts
    under it (which count as one document) that with the least digest, null
    last. Null and empty texts are in no group but their id's. Other columns
    may have any names.
    """
    found = stash(_components(docs, id_col, text_col, percent), "components")
    drop = found.where("not kept").select(F.col("doc_id").alias("_drop")).distinct()
    drop = broadcast_small(stash(drop, "dropped"))
    mine = F.col(f"d.{id_col}").cast("long")
    left = docs.alias("d").join(drop.alias("b"), mine == F.col("b._drop"), "left_anti")
    again = stash(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("_again")), "repeated")
    if again.isEmpty():
        return left
    again = broadcast_small(again).alias("b")
    same = mine == F.col("b._again")
    repeats = left.alias("d").join(again, same, "left_semi")
    digest = F.coalesce(F.sha1(F.col(f"d.{text_col}").cast("string")), F.lit("~"))
    least = repeats.alias("d").groupBy(mine.alias("_id")).agg(F.min(digest).alias("_digest"))
    least = broadcast_small(stash(least, "least-text")).alias("b")
    one = repeats.alias("d").join(least, (mine == F.col("b._id")) & (digest == F.col("b._digest")), "left_semi")
    return left.alias("d").join(again, same, "left_anti").unionByName(one.dropDuplicates([id_col]))
