"""Per-key record choice: first / last / most common / as-of.

All choices are aggregations with ``min`` over an ordering struct, not
``row_number`` windows: the aggregate is combined map-side, so a key that
holds a third of all rows is reduced to one row per map task before the
shuffle instead of landing whole in one sort task. Ties are broken by
explicit tie columns and then by the row's own values, so the choice is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.functions.expressions import abs_day_gap, false_if_null
from costlens.plans.materialise import dealt


def _asc_nulls_last(c: Column) -> list[Column]:
    return [c.isNull().cast("int"), c]


def pick_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row whose ``order`` tuple is smallest.

    ``order`` is a list of Columns compared left to right (ascending; put a
    null flag first where nulls must sort last). Rows that tie on it are told
    apart by the returned columns in their order, nulls first, so the row does
    not hang on the partitioning. Rows with a null key are kept as their own
    group (SQL GROUP BY semantics); filter them first if they must be dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in (columns or df.columns) if c not in keys]
    payload = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return (df.groupBy(*keys)
              .agg(F.min(F.struct(ordering.alias("_o"), payload.alias("_p"))).alias("_pick"))
              .select(*keys, *[F.col("_pick")["_p"][c].alias(c) for c in cols]))


def first_record(df: DataFrame, key: str, date: str, ties: Sequence[str] = (),
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Earliest-dated row per key (missing dates last), ties by ``ties`` ascending."""
    order = _asc_nulls_last(F.col(date)) + [F.col(t) for t in ties]
    return pick_per_key(df, key, order, columns)


def last_record(df: DataFrame, key: str, date: str, ties: Sequence[str] = (),
                columns: Sequence[str] | None = None) -> DataFrame:
    """Latest-dated row per key (rows with a missing date only if no dated row);
    ties by ``ties`` ascending."""
    d = F.col(date)
    order = [d.isNull().cast("int"), -F.datediff(d.cast("date"), F.lit("1970-01-01").cast("date"))]
    order += [F.col(t) for t in ties]
    return pick_per_key(df, key, order, columns)


def first_record_flag(df: DataFrame, key: str, date: str, flag_col: str, flag_value: str,
                      ties: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Keys whose first record (by ``date``, nulls last) has ``flag_col == flag_value``.

    Returns one row per such key with the first record's columns.
    """
    first = first_record(df, key, date, ties, columns)
    return first.filter(false_if_null(F.col(flag_col) == F.lit(flag_value)))


def mode_per_key(df: DataFrame, key: str, value: str, out: str = "mode_value") -> DataFrame:
    """Most common non-null ``value`` per key; ties go to the smallest value.

    Two aggregates: (key, value) counts, then max count per key. The rows are
    dealt to tasks by their number, so no task's table of groups grows with
    the input; a value that most rows of the table share is one row of it.
    """
    rows = df.filter(F.col(value).isNotNull()).select(key, value)
    counts = dealt(rows, key, value).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return (dealt(counts, key).groupBy(key)
                  .agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(out)))


def first_and_mode(df: DataFrame, key: str, date: str, ties: Sequence[str], value: str,
                   first_columns: Sequence[str], mode_out: str = "mode_value") -> DataFrame:
    """One row per key with the first record's ``first_columns`` (by ``date``,
    nulls last, then ``ties``) and the most common non-null ``value``.

    One scan, two aggregates: per (key, value) a count and the earliest
    record, then per key the mode and the earliest of those records. Both
    combine map-side.
    """
    order = F.struct(F.col(date).isNull().cast("int").alias("_nd"), F.col(date).alias("_d"),
                     *[F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)])
    payload = F.struct(*[F.col(c).alias(c) for c in first_columns])
    lvl1 = df.groupBy(key, value).agg(
        F.count(F.col(value)).alias("_n"),
        F.min(F.struct(order.alias("_o"), payload.alias("_p"))).alias("_m"))
    ranked = F.when(F.col(value).isNotNull(), F.struct(-F.col("_n"), F.col(value)))
    lvl2 = lvl1.groupBy(key).agg(F.min_by(F.col(value), ranked).alias(mode_out),
                                 F.min(F.col("_m")).alias("_m"))
    return lvl2.select(key, *[F.col(f"_m._p.{c}").alias(c) for c in first_columns], mode_out)


def asof_record(df: DataFrame, key: str, event_date: str, record_date: str,
                ties: Sequence[str] = ()) -> DataFrame:
    """Per key the latest record dated on or before the event; if none, the
    earliest record after it.

    A missing event date or record date makes the comparison false, so such
    records count as "after" (and among those, missing record dates come
    last). Ties on the date go to the smallest ``ties`` tuple.
    """
    ev, rd = F.col(event_date).cast("date"), F.col(record_date).cast("date")
    before = false_if_null(rd <= ev)
    day = F.datediff(rd, F.lit("1970-01-01").cast("date"))
    order = [
        (~before).cast("int"),                        # before-records first
        rd.isNull().cast("int"),                      # missing dates last
        F.when(before, -day).otherwise(day),          # latest before / earliest after
    ] + [F.col(t) for t in ties]
    return pick_per_key(df, key, order)


def keys_to_drop_new_units(first: DataFrame, key: str, event_date: str, record_date: str,
                           transaction_col: str, new_value: str, threshold_days: int) -> DataFrame:
    """From first records: keys of new units whose first certificate is less
    than ``threshold_days`` from the event (missing gap keeps the key)."""
    gap = abs_day_gap(event_date, record_date)
    return (first.filter(false_if_null(F.col(transaction_col) == F.lit(new_value))
                         & false_if_null(gap < F.lit(threshold_days)))
                 .select(key))


def exclude_new_units(df: DataFrame, key: str, event_date: str, record_date: str,
                      transaction_col: str, new_value: str, threshold_days: int,
                      ties: Sequence[str] = ()) -> DataFrame:
    """Drop every record of keys whose first record is a new unit certified
    within ``threshold_days`` of the event (strict ``<``)."""
    first = first_record(df, key, record_date, ties,
                         columns=[event_date, record_date, transaction_col])
    drop = keys_to_drop_new_units(first, key, event_date, record_date, transaction_col,
                                  new_value, threshold_days)
    return df.join(drop, on=key, how="left_anti")


def fill_category(df: DataFrame, key: str, date: str, value: str, transaction_col: str,
                  new_value: str, fill_value: str, ties: Sequence[str] = ()) -> DataFrame:
    """Overwrite ``value`` with ``fill_value`` on all records of keys whose
    first record is a new unit; then fill remaining nulls with the key's most
    common value.

    For new-unit keys every record is overwritten, so their most common value
    is ``fill_value`` and no nulls remain; for other keys the mode of the
    original values is used. Both per-key facts come from one key-grouped
    table, joined back once.
    """
    facts = first_and_mode(df, key, date, ties, value, [transaction_col], "_mode")
    per_key = facts.select(key, false_if_null(F.col(transaction_col) == F.lit(new_value)).alias("_new"), "_mode")
    joined = df.join(per_key, on=key, how="left")
    filled = F.when(F.col("_new"), F.lit(fill_value)).otherwise(F.coalesce(F.col(value), F.col("_mode")))
    return joined.withColumn(value, filled).drop("_new", "_mode").select(*df.columns)
