"""Range (band) join with a top-k mean: the "similar homes" average.

For each query row: data rows with rooms within +-``room_band`` and area
within +-``area_band``; if there are more than ``k`` of them, the mean value
of the ``k`` latest (by ``order`` descending, missing last, ties by ``tie``,
then by the value), else null.

Exact, and no pair of rows or cells is ever built:

* The band test depends only on a row's (rooms, area) *cell*, so a cell is
  wholly inside or outside any band. Data cells and the two ends of every
  query cell's band are dealt by range of (rooms, area) and numbered with
  running sums, so each band becomes one interval of cell numbers for each
  rooms value in it, and its count a difference of two running counts.
* Queries of one rooms value whose bands begin and end close together are a
  *bundle*: both ends move up with the area, so a bundle of ``BUNDLE`` steps
  reads that many cells at its two fringes, and all cells between them lie in
  all of its bands. The fringes' rows (``k`` a cell at most) go to the bundle's
  task, which keeps the ``k`` latest rows while an end moves over them. Of the
  cells between, cut into blocks of 64, 256, ... cells that keep their ``k``
  latest rows, a bundle gets ``k`` rows. So the rows that tasks read grow with
  the cells and queries, not with the cells in a band, and none is copied for
  every query.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens import config as C
from costlens.plans.materialise import broadcast_if_small, materialise

_LOW, _CELL, _HIGH = 0, 1, 2  # a band's low end counts the cells before it, its high end also those at it
# Steps of a bundle's ends over cells and other queries, and the cells of the least block (a power of 2).
BUNDLE, BLOCK_BITS = 1 << 15, 6
_BASE, _FRINGE, _ASK = 0, 1, 2


def _known(rooms: Column, area: Column) -> Column:
    return rooms.isNotNull() & area.isNotNull() & ~F.isnan(rooms) & ~F.isnan(area)


def block_cover(lo: Column, hi: Column, levels: int) -> Column:
    """Array of (level, block): the fewest blocks of 4^level cells that make up the cells ``lo`` to ``hi`` - 1."""

    def run(first: Column, end: Column, level: int) -> Column:
        each = F.transform(F.sequence(first, end - 1), lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))
        return F.when(first < end, each).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

    parts = []
    for level in range(levels):
        first = F.shiftright(lo + F.lit((1 << 2 * level) - 1), 2 * level)
        end = F.shiftright(hi, 2 * level)
        inner = F.least(F.shiftleft(F.shiftright(first + 3, 2), 2), end)  # from here on, blocks of the next level
        outer = F.greatest(F.shiftleft(F.shiftright(end, 2), 2), inner)   # up to here
        parts += [run(first, inner, level), F.when(first < end, run(outer, end, level)).otherwise(
            F.array().cast("array<struct<level:int,block:bigint>>"))]
    return F.concat(*parts)


def _numbered(cells: DataFrame, ends: DataFrame) -> DataFrame:
    """Cells and band ends with ``at``, the cells up to the row, ``upto``, the data rows in them, and ``asks``, the low ends up to it."""
    none = F.lit(None).cast("double")
    both = cells.select("r", "a", F.lit(_CELL).alias("kind"), "n", none.alias("qr"), none.alias("qa")).unionByName(ends)
    key = ["r", "a", "kind"]
    counts = ["at", "upto", "asks"]

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts inside the range of the sort key that the task has."""
        total = [0, 0, 0]
        for b in batches:
            kind, n = b.column("kind").to_numpy(), b.column("n").to_numpy()
            sums = [np.cumsum(v, dtype=np.int64) + t for v, t in zip((kind == _CELL, n, kind == _LOW), total)]
            total = [int(v[-1]) if len(v) else t for v, t in zip(sums, total)]
            kept = [*key, "qr", "qa", "part"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(v) for v in sums], names=[*kept, *counts])

    rows = both.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("part", F.spark_partition_id())
    rows = materialise(rows.mapInArrow(running, "r double, a double, kind int, qr double, qa double, part int, at long, upto long, asks long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    spans = rows.groupBy("part").agg(*[F.max(c).alias(c) for c in counts]).select(
        F.col("part").alias("p"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in counts])
    return rows.join(F.broadcast(materialise(spans)), F.col("part") == F.col("p")).select(
        *key, "qr", "qa", *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in counts])


def _latest_while_moving(ranks: list, start: int, ends: list, k: int) -> list:
    """The ``k`` least of ``ranks`` between ``start`` and each of ``ends``, which move away from it (either way)."""
    out, held, at = [], [], start
    now: tuple = ()
    for end in ends:
        new = ranks[at:end] if end >= at else ranks[end:at]
        at = end
        if len(held) == k:
            worst = held[-1]
            new = [v for v in new if v < worst]
        if new:
            if len(new) > k:
                held = sorted([*held, *new])[:k]
            else:
                for v in new:
                    insort(held, v)
                del held[k:]
            now = tuple(held)
        out.append(now)
    return out


def _bundle_means(k: int):
    """(qr, qa, mean of the k latest rows) of bundles that come sorted."""

    def means(parts: list) -> tuple[np.ndarray, list]:
        kind, x, r, i, j, has = map(np.concatenate, zip(*parts))
        data, ask = kind != _ASK, kind == _ASK
        value = dict(zip(j[data].tolist(), (v if h else None for v, h in zip(x[data].tolist(), has[data].tolist()))))
        base = tuple(sorted(j[kind == _BASE].tolist())[:k])
        fringe = kind == _FRINGE
        order = np.argsort(i[fringe], kind="stable")
        at, ranks = i[fringe][order], j[fringe][order].tolist()
        asked, place = np.unique(x[ask], return_inverse=True)
        found: list = [[base] for _ in asked]
        r, lo, hi = r[ask], i[ask], j[ask]
        order = np.lexsort((place, r))
        r, lo, hi, place = r[order], lo[order], hi[order], place[order]
        first, last = np.searchsorted(at, lo).tolist(), np.searchsorted(at, hi).tolist()
        edges = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
        for begin, stop in zip(edges, edges[1:]):
            while begin < stop:
                # The queries whose band reaches the end of the first one's: what lies before it, and what lies behind it.
                middle = last[begin]
                end = begin + int(np.searchsorted(lo[begin:stop], hi[begin], side="right"))
                left = _latest_while_moving(ranks, middle, first[begin:end][::-1], k)[::-1]
                right = _latest_while_moving(ranks, middle, last[begin:end], k)
                for p, a, b in zip(place[begin:end].tolist(), left, right):
                    found[p] += (a, b)
                begin = end
        out, seen, mean = [], None, None
        for lists in found:
            if lists != seen:
                seen = lists
                got = [v for v in map(value.get, sorted(v for one in lists for v in one)[:k]) if v is not None]
                mean = sum(got) / len(got) if got else None
            out.append(mean)
        return asked, out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            asked, out = means(held)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(asked), key[0])), pa.array(asked), pa.array(out, pa.float64())],
                                              names=["qr", "qa", "mean"])

        for b in batches:
            qr, bundle, *cols = (b.column(c).to_numpy(zero_copy_only=False) for c in ("qr", "bundle", "kind", "x", "r", "i", "j", "has"))
            edges = [0, *(np.flatnonzero((qr[1:] != qr[:-1]) | (bundle[1:] != bundle[:-1])) + 1).tolist(), len(qr)]
            for begin, stop in zip(edges, edges[1:]):
                if begin == stop:
                    continue
                if key is not None and key != (qr[begin], bundle[begin]):
                    yield done()
                    held = []
                key = qr[begin], bundle[begin]
                held.append([c[begin:stop] for c in cols])
        if held:
            yield done()

    return run


def bundle_rows(top: DataFrame, asks: DataFrame, k: int, cells: int) -> DataFrame:
    """What the bundles' tasks read: (qr, bundle, kind, x, r, i, j, has).

    ``top`` has the k latest rows of each cell (at, v, has, rank), ``asks``
    a row for each query cell and rooms value in its band (qr, bundle, qa, r,
    lo, hi). Base rows lie in all bands of the bundle, fringe rows in some.
    """
    def up(c: str) -> Column:
        return F.shiftright(F.max(c) + F.lit((1 << BLOCK_BITS) - 1), BLOCK_BITS)

    spans = materialise(asks.groupBy("qr", "bundle", "r").agg(
        F.shiftright(F.min("lo"), BLOCK_BITS).alias("a"), up("lo").alias("b"), F.shiftright(F.min("hi"), BLOCK_BITS).alias("c"), up("hi").alias("d")))
    inside = F.col("b") < F.col("c")

    def each(first: Column, end: Column) -> Column:
        return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))

    fringe = spans.select("qr", "bundle", F.explode(F.when(inside, F.concat(
        each(F.col("a"), F.col("b")), each(F.col("c"), F.col("d")))).otherwise(each(F.col("a"), F.col("d")))).alias("block")).distinct()  # a block may have cells of two rooms values
    levels = 1 + (max((cells - 1) >> BLOCK_BITS, 0).bit_length() + 1) // 2  # 4^(levels - 1) blocks or less
    wanted = spans.where(inside).select("qr", "bundle", F.explode(block_cover(F.col("b"), F.col("c"), levels)).alias("w")).select(
        "qr", "bundle", "w.level", "w.block")

    def cut(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("rank"))).where(F.col("rn") <= k).drop("rn")

    data = top.withColumn("block", F.shiftright("at", BLOCK_BITS))
    least = materialise(cut(data.select("block", "v", "has", "rank"), "block"))
    blocks = least.select("v", "has", "rank", F.explode(F.array(*[
        F.struct(F.lit(j).alias("level"), F.shiftright("block", 2 * j).alias("block")) for j in range(levels)])).alias("b")).select(
        "v", "has", "rank", "b.level", "b.block")
    base = cut(wanted.join(cut(blocks, "level", "block"), ["level", "block"]), "qr", "bundle")

    def rows(df: DataFrame, kind: int, x: str, r, i, j: str, has) -> DataFrame:
        return df.select("qr", "bundle", F.lit(kind).alias("kind"), F.col(x).alias("x"), r.alias("r"), i.alias("i"), F.col(j).alias("j"), has.alias("has"))

    zero = F.lit(0.0)
    return rows(base, _BASE, "v", zero, F.lit(0).cast("long"), "rank", F.col("has")).unionByName(
        rows(fringe.join(data, "block"), _FRINGE, "v", zero, F.col("at"), "rank", F.col("has"))).unionByName(
        rows(asks, _ASK, "qa", F.col("r"), F.col("lo"), "hi", F.lit(True)))


def band_topk_mean(query: DataFrame, data: DataFrame, rooms: str, area: str, value: str,
                   order: str, tie: str, room_band: float = C.BAND_ROOMS,
                   area_band: float = C.BAND_AREA, k: int = C.BAND_TOP_K,
                   out: str = "neighbour_mean") -> DataFrame:
    """Add ``out`` to every ``query`` row (see module docstring).

    A row without rooms or area (null or NaN) has no neighbours and is none.
    Null values count as neighbours and are left out of the mean. Repeated
    rows count once each. Without data every mean is null. Bands are taken
    in double precision.
    """
    r, a = F.col(rooms).cast("double"), F.col(area).cast("double")
    d = data.where(_known(r, a)).select(r.alias("r"), a.alias("a"), F.col(value).alias("v"), F.col(order).alias("o"), F.col(tie).alias("t"))
    asked = materialise(query.where(_known(r, a)).select(r.alias("qr"), a.alias("qa")).distinct())
    cells = materialise(d.groupBy("r", "a").agg(F.count(F.lit(1)).alias("n")))
    # Rooms values meet through buckets as wide as the band; a query value has as many partners as its band has values.
    bucket = lambda c: F.floor(c / F.lit(room_band)).cast("bigint")
    of = asked.select("qr").distinct().withColumn("b", F.explode(F.sequence(bucket(F.col("qr") - room_band), bucket(F.col("qr") + room_band))))
    near = of.join(cells.select("r").distinct().withColumn("b", bucket(F.col("r"))), "b").where(
        (F.col("r") >= F.col("qr") - F.lit(room_band)) & (F.col("r") <= F.col("qr") + F.lit(room_band))).select(F.col("qr").alias("q"), "r")
    ends = asked.join(broadcast_if_small(near), F.col("qr") == F.col("q")).select(
        "r", "qr", "qa", F.explode(F.array(
            F.struct((F.col("qa") - F.lit(area_band)).alias("a"), F.lit(_LOW).alias("kind")),
            F.struct((F.col("qa") + F.lit(area_band)).alias("a"), F.lit(_HIGH).alias("kind")))).alias("e")).select(
        "r", "e.a", "e.kind", F.lit(0).cast("long").alias("n"), "qr", "qa")
    placed = _numbered(cells, ends)

    def end(kind: int, c: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(c)))

    # Dealt by the query cell once, for both groupings.
    bands = placed.where(F.col("kind") != _CELL).select("qr", "qa", "r", "kind", "at", "upto", "asks").repartition("qr", "qa").groupBy(
        "qr", "qa", "r").agg(end(_LOW, "at").alias("lo"), end(_HIGH, "at").alias("hi"), end(_LOW, "asks").alias("asks"),
                             (end(_HIGH, "upto") - end(_LOW, "upto")).alias("n"))
    # All of these counts move up with the area, so queries of a bundle are next to one another.
    enough = bands.groupBy("qr", "qa").agg(F.sum("n").alias("n"), F.sum(F.col("lo") + F.col("hi") + F.col("asks")).alias("steps"),
                                           F.collect_list(F.struct("r", "lo", "hi")).alias("runs")).where(F.col("n") > k)
    asks = materialise(enough.select("qr", "qa", F.floor(F.col("steps") / BUNDLE).alias("bundle"), F.explode("runs").alias("run")).select(
        "qr", "bundle", "qa", "run.*"))

    latest = [F.col("o").desc_nulls_last(), F.col("t").asc_nulls_last(), F.col("v").asc_nulls_last()]
    cell = Window.partitionBy("r", "a").orderBy(*latest)
    some = d.withColumn("rn", F.row_number().over(cell)).where(F.col("rn") <= k).drop("rn")
    number = placed.where(F.col("kind") == _CELL).select(F.col("r").alias("cr"), F.col("a").alias("ca"), (F.col("at") - 1).alias("at"))
    some = materialise(some.join(number, (F.col("r") == F.col("cr")) & (F.col("a") == F.col("ca"))).select("at", "v", "o", "t"))
    # Rows sorted by range get numbers in that order; rows that tie have the same value.
    top = materialise(some.repartitionByRange(*latest, F.col("at")).sortWithinPartitions(*latest).select(
        "at", F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"), F.col("v").isNotNull().alias("has"),
        F.monotonically_increasing_id().alias("rank")))
    bundles = bundle_rows(top, asks, k, cells.count()).repartition("qr", "bundle").sortWithinPartitions("qr", "bundle")
    means = bundles.mapInArrow(_bundle_means(k), "qr double, qa double, mean double").withColumn(
        "mean", F.col("mean").cast(d.agg(F.avg("v")).schema[0].dataType))
    r, a = F.col(f"q.`{rooms}`").cast("double"), F.col(f"q.`{area}`").cast("double")
    return query.alias("q").join(means.alias("m"), (r == F.col("m.qr")) & (a == F.col("m.qa")), "left").select(
        "q.*", F.col("m.mean").alias(out))
