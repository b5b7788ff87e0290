"""Row filters and cell cleaning (narrow transformations, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens import config as C
from costlens.functions.expressions import false_if_null, not_in_ci, null_if_matches


def null_out_strings(df: DataFrame, pattern: str = C.UNKNOWN_PATTERN) -> DataFrame:
    """Every string cell containing ``pattern`` becomes null; other types untouched."""
    exprs = [null_if_matches(f.name, pattern).alias(f.name) if isinstance(f.dataType, T.StringType)
             else F.col(f.name) for f in df.schema.fields]
    return df.select(*exprs)


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.na.drop(how="any", subset=list(subset))


def relevant_rows(df: DataFrame, cols: C.Columns = C.Columns(), tech_type: str = C.TECH_TYPE_KEPT,
                  denied_install_types: Sequence[str] = C.DENIED_INSTALL_TYPES) -> DataFrame:
    """Rows useful for modelling: cost, record id and record date present;
    the wanted technology; installation type not denied (missing kept); not
    flagged as part of a cluster (a missing flag keeps the row)."""
    return (drop_null_rows(df, [cols.cost, cols.record_id, cols.record_date])
            .filter(F.col(cols.tech_type) == F.lit(tech_type))
            .filter(not_in_ci(cols.install_type, denied_install_types))
            .filter(~false_if_null(F.col(cols.cluster))))


def bounds_filter(df: DataFrame, column: str, lower=None, upper=None) -> DataFrame:
    """Inclusive optional bounds; a null value fails any bound that is given."""
    if lower is not None:
        df = df.filter(F.col(column) >= F.lit(lower))
    if upper is not None:
        df = df.filter(F.col(column) <= F.lit(upper))
    return df


def allow_list(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    if values is None:
        return df
    return df.filter(F.col(column).isin(list(values)))


def share_over_threshold(df: DataFrame, column: str, threshold: float, by: Sequence[str] = ()):
    """Count and percentage of rows with ``column >= threshold`` (null counts as no)."""
    cond = false_if_null(F.col(column) >= F.lit(threshold))
    aggs = [F.count_if(cond).cast("bigint").alias("n_over"),
            F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.round(F.avg(cond.cast("double")) * 100.0, 6).alias("pct_over")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
