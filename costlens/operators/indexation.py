"""Price-index adjustment of costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.expressions import quarter_label


def reference_value(index_df: DataFrame, ref_year: int, title: str = "title",
                    value: str = "value") -> DataFrame:
    """One-row table: the whole-year index value of ``ref_year``.

    Always exactly one row (null when the year is absent), so it can be
    broadcast with a proven size bound.
    """
    v = F.expr(f"try_cast({value} AS DOUBLE)")
    return index_df.filter(F.col(title) == F.lit(str(ref_year))).agg(F.min(v).alias("ref_value"))


def quarterly_factors(index_df: DataFrame, ref_year: int, title: str = "title",
                      value: str = "value") -> DataFrame:
    """Quarterly rows (title containing "Q") with ``adjustment_factor = 1 + (ref - v) / v``."""
    ref = reference_value(index_df, ref_year, title, value)
    v = F.expr(f"try_cast({value} AS DOUBLE)")
    q = index_df.filter(F.col(title).contains("Q")).withColumn("index_value", v)
    return (q.crossJoin(F.broadcast(ref))
             .withColumn("adjustment_factor",
                         F.lit(1.0) + F.try_divide(F.col("ref_value") - F.col("index_value"),
                                                   F.col("index_value")))
             .drop("ref_value"))


def adjust_costs(df: DataFrame, factors: DataFrame, date: str, cost: str, title: str = "title",
                 out: str = "adjusted_cost") -> DataFrame:
    """Label each row's quarter, left-join the quarter's factor, scale the cost."""
    f = factors.select(F.col(title).alias("_title"), "adjustment_factor")
    df = df.withColumn("year_quarter", quarter_label(date))
    j = df.join(f, F.col("year_quarter") == F.col("_title"), "left").drop("_title")
    return j.withColumn(out, F.col(cost) * F.col("adjustment_factor"))
