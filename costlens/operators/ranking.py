"""Exact row numbers without a global window.

Rows are dealt by range of the sort key, numbered inside their range, and
moved on by the counts of the ranges before. Only one row per (range, group)
goes through a window, so no task holds more than its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costlens.plans.materialise import broadcast_if_small, materialise

_ROW_BITS = 33  # monotonically_increasing_id: the range above, the row number within it below


def free_names(columns: Sequence[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores added until no column has it (case ignored)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def exact_rank(df: DataFrame, order: Sequence[str | Column], groups: Sequence[str] = (), out: str = "rank",
               total: str | None = None) -> DataFrame:
    """Every row with its 0-based place ``out`` in its group by ``order`` (ascending, nulls first).

    ``total`` names a column for the number of rows in the group. Null
    groups are groups like others. Rows that tie on ``order`` get places in
    an arbitrary order; order them by all that tells them apart where that
    matters. Ties are spread over ranges, so a key that holds most rows does
    not fill one task. ``df`` must read alike twice (a written table or a
    plan over one), as ties are told apart by the place they were read from.
    An empty table gives an empty table.
    """
    tie, at, part, first, n, base, size = free_names(
        [*df.columns, out, total or out], "_tie", "_at", "_part", "_first", "_n", "_base", "_size")
    keys = [F.col(g).asc_nulls_first() for g in groups] + [
        (F.col(o) if isinstance(o, str) else o).asc_nulls_first() for o in order] + [F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialise(dealt.withColumn(at, F.monotonically_increasing_id()).drop(tie))
    rows = rows.withColumn(part, F.shiftright(at, _ROW_BITS)).withColumn(
        at, F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    spans = rows.groupBy(*groups, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*groups, part, (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first)).alias(base),
                         F.sum(n).over(Window.partitionBy(*groups)).alias(size))
    spans = broadcast_if_small(spans).alias("s")
    on = F.col(f"r.{part}") == F.col(f"s.{part}")
    for g in groups:
        on = on & F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}"))
    cols = [F.col(f"r.{c}") for c in df.columns] + [(F.col(f"r.{at}") + F.col(f"s.{base}")).alias(out)]
    if total:
        cols.append(F.col(f"s.{size}").alias(total))
    return rows.alias("r").join(spans, on).select(*cols)
