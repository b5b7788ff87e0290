"""Column expressions (all JVM-side, inside whole-stage codegen).

Each function returns a ``Column``; none runs Python per row.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlens import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_matches(c, pattern: str = C.UNKNOWN_PATTERN) -> Column:
    """Null a string cell that *contains* ``pattern`` (regex); keep others."""
    c = col(c)
    return F.when(~c.rlike(pattern), c)


def cap_value(c, cap: float) -> Column:
    """``cap`` when the value is above it; nulls stay null (unlike ``least``)."""
    c = col(c)
    return F.when(c > F.lit(cap), F.lit(cap)).otherwise(c)


def not_in_ci(c, values) -> Column:
    """Case-insensitive ``NOT IN`` that keeps nulls (pandas ``~isin``)."""
    c = col(c)
    return F.coalesce(~F.lower(c).isin([v.lower() for v in values]), F.lit(True))


def false_if_null(cond: Column) -> Column:
    """A comparison against a missing value counts as false."""
    return F.coalesce(cond, F.lit(False))


def days_since(d, start: str) -> Column:
    """Whole days from ``start`` to the date ``d`` (dates, not times)."""
    return F.datediff(col(d).cast("date"), F.to_date(F.lit(start))).cast("bigint")


def abs_day_gap(a, b) -> Column:
    return F.abs(F.datediff(col(a).cast("date"), col(b).cast("date"))).cast("bigint")


def quarter_label(d) -> Column:
    """``YYYY Qn`` per row; null when the date is null."""
    d = col(d)
    return F.concat(F.year(d).cast("string"), F.lit(" Q"), F.quarter(d).cast("string"))


def adjustment_factor(reference_value, value) -> Column:
    """``1 + (ref - v) / v`` on the numeric reading of the index value."""
    v = F.expr(f"try_cast({value} AS DOUBLE)") if isinstance(value, str) else value
    ref = col(reference_value) if isinstance(reference_value, str) else F.lit(reference_value)
    return F.lit(1.0) + F.try_divide(ref - v, v)


def map_values(c, mapping: dict) -> Column:
    """Dictionary recode; values not in the dictionary become null."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, col(c))


def collapse_built_form(c) -> Column:
    """"...End-Terrace..." -> "End-Terrace", else "...Mid-Terrace..." -> "Mid-Terrace"."""
    c = col(c)
    return (F.when(c.contains("End-Terrace"), F.lit("End-Terrace"))
            .when(c.contains("Mid-Terrace"), F.lit("Mid-Terrace"))
            .otherwise(c))


def normalise_text(c) -> Column:
    """Lower-case; blanks and hyphens become underscores."""
    return F.translate(F.lower(col(c)), " -", "__")


def rooms_category(c, cap: int = C.ROOMS_CAP) -> Column:
    """Room count as a category: whole values 1..cap-1 as text, ``cap`` and
    above as ``"{cap}+"``; other values (non-whole, below 1, null) are null."""
    c = col(c)
    whole = (c == F.floor(c)) & (c >= 1) & (c < cap)
    return (F.when(c > cap, F.lit(f"{cap}+"))
            .when(c == cap, F.lit(f"{cap}+"))
            .when(whole, F.floor(c).cast("bigint").cast("string")))


def bin_up(c, width: float, max_value: float) -> Column:
    """Upper edge of a ``width``-wide bin (first bin is ``width``); null above ``max_value``."""
    c = col(c)
    return F.when(c <= max_value,
                  F.greatest(F.ceil(c / F.lit(width)), F.lit(1)) * F.lit(width)).cast("double")


def date_weight(d, start: str, weight: float = 2.0) -> Column:
    """Weight ``weight`` from ``start`` on, else 1 (null date -> 1)."""
    return F.when(false_if_null(col(d) >= F.to_date(F.lit(start))), F.lit(float(weight))).otherwise(F.lit(1.0))


def rule_table_estimate(is_bungalow, rooms, is_detached) -> Column:
    """Price from the fixed rule table; first matching branch wins, else null."""
    b, r, d = col(is_bungalow), col(rooms), col(is_detached)

    def lookup(table: dict) -> Column:
        expr = None
        for k, v in table.items():
            expr = (F.when(r == k, F.lit(float(v))) if expr is None
                    else expr.when(r == k, F.lit(float(v))))
        return expr

    bung = b.cast("boolean")
    det = d.cast("boolean")
    return (F.when(bung, lookup(C.RULE_TABLE_BUNGALOW))
            .when(~bung & det, lookup(C.RULE_TABLE_DETACHED))
            .when(~bung & ~det, lookup(C.RULE_TABLE_OTHER)))


def pinball(y, p, alpha: float) -> Column:
    y, p = col(y), col(p)
    return F.when(y >= p, F.lit(alpha) * (y - p)).otherwise(F.lit(1.0 - alpha) * (p - y))
