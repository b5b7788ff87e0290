"""Exact quantiles per group without holding a group in one task.

A bounded sketch brackets each wanted rank; the error of the sketch is known,
so the bracket surely holds the rank. The sketches, a row a group, are written
and broadcast if they are few. One more pass counts the rows below
each bracket and keeps only the distinct values inside, about ``4 /
accuracy`` of a group, with their counts. Both passes combine before the
shuffle, and equal values are one row; no row is shuffled or sorted by its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costlens.operators.ranking import free_names
from costlens.plans.materialise import broadcast_if_small, materialise

ACCURACY = 10_000


def same_groups(left: DataFrame, right: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, null groups included; without groups both sides have one row to join."""
    if not groups:
        return left.crossJoin(F.broadcast(right))
    names = {g: f"_right_{g}" for g in groups}
    on = [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


def _at_rank(kept: Column, bracket: Column, below: Column, rank: Column) -> Column:
    """The value at a 0-based rank, counted on from the rows below the bracket through its sorted (v, n, zone) structs."""
    start = F.struct(below.alias("seen"), F.lit(None).cast("double").alias("v"))
    step = lambda a, x: F.when(a["v"].isNotNull() | (x["zone"] <= bracket), a).otherwise(F.struct(
        (a["seen"] + x["n"]).alias("seen"), F.when(a["seen"] + x["n"] > rank, x["v"]).alias("v")))
    return F.aggregate(kept, start, step, lambda a: a["v"])


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str | Column, probs: Sequence[float],
                    method: str = "linear", accuracy: int = ACCURACY) -> DataFrame:
    """Per group the quantiles of ``value`` as columns q0, q1, ... in the order of ``probs`` (ascending).

    ``linear`` interpolates between order statistics; ``lower`` is the
    smallest value with at least that share of the rows at or below it. Null
    values are ignored; a group of nulls only has null quantiles. In a group
    of at most ``accuracy`` rows the bracket is the group.
    """
    probs = [float(p) for p in probs]
    if probs != sorted(probs):
        raise ValueError("probs must ascend")
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*groups, v.alias("_v"))
    # The sketch errs by n / accuracy ranks, and interpolation reaches two ranks further, at most 2 n / accuracy.
    reach = 4.0 / accuracy
    grid = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = rows.groupBy(*groups).agg(F.percentile_approx("_v", grid, accuracy).alias("_s"), F.count("_v").alias("_n"))
    whole = F.col("_n") <= accuracy
    brackets = F.transform(F.array(*[F.lit(i) for i in range(len(probs))]), lambda i: F.struct(
        F.when(whole, float("-inf")).otherwise(F.get("_s", 2 * i)).alias("lo"),
        F.when(whole, float("nan")).otherwise(F.get("_s", 2 * i + 1)).alias("hi")))  # NaN is above all values
    rows = same_groups(rows, broadcast_if_small(sketch.select(*groups, brackets.alias("_b"))), groups)
    value_ = F.col("_v")
    inside = F.exists("_b", lambda x: value_.between(x["lo"], x["hi"]))
    # The number of brackets that begin at or below the value; brackets ascend with the probabilities.
    zone = F.size(F.filter("_b", lambda x: value_ >= x["lo"]))
    # Counts only: an array beside them would have every row sorted.
    counted = rows.groupBy(*groups, F.when(inside, value_).alias("_in"), zone.alias("_zone")).agg(F.count("_v").alias("_c"))
    row = F.struct(F.col("_in").alias("v"), F.col("_c").alias("n"), F.col("_zone").alias("zone"))
    per = counted.groupBy(*groups).agg(F.sum("_c").alias("_n"), F.sort_array(F.collect_list(row)).alias("_rows"))
    per = per.withColumn("_kept", F.filter("_rows", lambda x: x["v"].isNotNull()))

    def quantile(p: Column, i: Column) -> Column:
        below = F.aggregate("_rows", F.lit(0).cast("long"), lambda a, r: a + F.when(r["zone"] <= i, r["n"]).otherwise(F.lit(0)))
        if method == "lower":
            return _at_rank(F.col("_kept"), i, below, F.greatest(F.ceil(p * F.col("_n")) - 1, F.lit(0)))
        h = p * (F.col("_n") - 1)
        a, b = (_at_rank(F.col("_kept"), i, below, r) for r in (F.floor(h), F.ceil(h)))
        return a + (b - a) * (h - F.floor(h))

    per = per.select(*groups, F.transform(F.array(*map(F.lit, probs)), quantile).alias("_q"))
    return per.select(*groups, *[F.get("_q", i).alias(f"q{i}") for i in range(len(probs))])


def _values_at(sums: DataFrame, groups: Sequence[str], val: str, wt: str, wanted) -> DataFrame:
    """(groups, i, total, v): the least value at which the running weight reaches each wanted one.

    ``sums`` has a row per (group, value) with its weight; ``wanted`` gives an
    array of (i, need) structs from the group's total weight. The rows are
    dealt by range of (group, value); the weights of the ranges before tell
    which range holds a wanted weight, and only there weights are summed row
    by row. No task holds more than a range, however many are wanted.
    """
    part, base, total, upto, want = free_names([*groups, val, wt], "_part", "_base", "_total", "_upto", "_want")
    keys = [F.col(g).asc_nulls_first() for g in groups] + [F.col(val)]
    rows = materialise(sums.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(*groups, part).agg(F.sum(wt).alias(wt)).select(
        *groups, part, wt, F.coalesce(F.sum(wt).over(before), F.lit(0.0)).alias(base), F.sum(wt).over(Window.partitionBy(*groups)).alias(total))
    need = F.greatest(F.col(want)["need"], F.lit(1e-300))
    spans = spans.withColumn(want, F.explode(wanted(F.col(total)))).where((F.col(base) < need) & (need <= F.col(base) + F.col(wt)))
    spans = broadcast_if_small(spans.drop(wt)).alias("s")
    on = F.col(f"r.{part}") == F.col(f"s.{part}")
    for g in groups:
        on = on & F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}"))
    inside = rows.alias("r").join(spans, on).select(*[F.col(f"r.{g}") for g in groups], F.col(f"r.{part}"), F.col(f"r.{val}"),
                                                    F.col(f"r.{wt}"), F.col(f"s.{base}"), F.col(f"s.{total}"), F.col(f"s.{want}"))
    running = Window.partitionBy(*groups, part, want).orderBy(val).rowsBetween(Window.unboundedPreceding, 0)
    hit = inside.withColumn(upto, F.col(base) + F.sum(wt).over(running)).where(F.col(upto) >= need)
    return hit.groupBy(*groups, F.col(want)["i"].alias("i"), F.col(total).alias("total")).agg(F.min(val).alias("v"))


def weighted_quantiles(df: DataFrame, groups: Sequence[str], value: str | Column, weight: str | Column,
                       probs: Sequence[float]) -> DataFrame:
    """Per group the weighted quantiles of ``value`` as columns q0, q1, ...: the least value at which the weight at or
    below it reaches that share of the group's weight.

    Exact for weights whose sums are (whole numbers); rows with a null value,
    or a null, zero or negative weight are left out, and a group of such rows
    only has none.
    """
    v, w = ((F.col(c) if isinstance(c, str) else c).cast("double") for c in (value, weight))
    val, wt = free_names([*groups, "i", "total", "v"], "_v", "_w")
    sums = df.select(*groups, v.alias(val), w.alias(wt)).where(F.col(val).isNotNull() & (F.col(wt) > 0)).groupBy(*groups, val).agg(
        F.sum(wt).alias(wt))
    hit = _values_at(sums, groups, val, wt, lambda total: F.array(*[
        F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * total * (1 - 1e-12)).alias("need")) for i, p in enumerate(probs)]))
    cols = [F.min(F.when(F.col("i") == i, F.col("v"))).alias(f"q{i}") for i in range(len(probs))]
    return hit.groupBy(*groups).agg(*cols) if groups else hit.agg(*cols)


def ranked_quantiles(df: DataFrame, groups: Sequence[str], value: str | Column, probs: Sequence[float]) -> DataFrame:
    """(groups, i, q): the quantiles of ``value`` by place ``i`` in ``probs``, interpolated between order statistics.

    The same numbers as ``exact_quantiles``, a row each, for many probabilities
    over large groups: distinct values are shuffled once and no row or task
    grows with the group. Null values are left out; a group of nulls only has
    no rows.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    val, wt = free_names([*groups, "i", "total", "v"], "_v", "_w")
    sums = df.select(*groups, v.alias(val)).where(F.col(val).isNotNull()).groupBy(*groups, val).agg(
        F.count(F.lit(1)).cast("double").alias(wt))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])

    def wanted(total: Column) -> Column:
        ends = F.transform(steps, lambda s: F.array(
            F.struct((2 * s["i"]).alias("i"), (F.floor(s["p"] * (total - 1)) + 1).cast("double").alias("need")),
            F.struct((2 * s["i"] + 1).alias("i"), (F.ceil(s["p"] * (total - 1)) + 1).cast("double").alias("need"))))
        return F.flatten(ends)

    hit = _values_at(sums, groups, val, wt, wanted).withColumn("_odd", F.col("i") % 2).withColumn("i", (F.col("i") / 2).cast("int"))
    both = hit.groupBy(*groups, "i", "total").agg(F.min(F.when(F.col("_odd") == 0, F.col("v"))).alias("_a"),
                                                  F.min(F.when(F.col("_odd") == 1, F.col("v"))).alias("_b"))
    h = F.get(steps, F.col("i"))["p"] * (F.col("total") - 1)
    return both.select(*groups, "i", (F.col("_a") + (F.col("_b") - F.col("_a")) * (h - F.floor(h))).alias("q"))
