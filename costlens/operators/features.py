"""Feature building: category recoding, one-hot columns, standardising.

One-hot columns are built against a declared list of levels, so the output
schema never depends on the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions.expressions import (collapse_built_form, map_values, normalise_text,
                                            rooms_category)


def one_hot(df: DataFrame, levels: Mapping[str, Sequence], sep: str = "_",
            drop_original: bool = False) -> DataFrame:
    """0/1 integer column ``{col}{sep}{value}`` per declared level; a null or
    undeclared value gives all zeros."""
    new = []
    for c, vals in levels.items():
        for v in vals:
            new.append(F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
                       .cast("int").alias(f"{c}{sep}{v}"))
    out = df.select("*", *new)
    if drop_original:
        out = out.drop(*levels.keys())
    return out


def recode_categories(df: DataFrame, cols: C.Columns = C.Columns(), region: str = "region_name",
                      age_groups: Mapping[str, str] = C.AGE_BAND_GROUPS) -> DataFrame:
    """Age band to five groups, built form collapsed, text normalised."""
    df = (df.withColumn(cols.age_band, map_values(cols.age_band, age_groups))
            .withColumn(cols.built_form, collapse_built_form(cols.built_form)))
    for c in (cols.built_form, cols.property_type, cols.age_band, region):
        df = df.withColumn(c, normalise_text(c))
    return df


def dummify(df: DataFrame, levels: Mapping[str, Sequence], cols: C.Columns = C.Columns(),
            numeric: Sequence[str] = ("n_days",), region: str = "region_name",
            rooms_as_categorical: bool = False, rooms_cap: int = C.ROOMS_CAP) -> DataFrame:
    """Drop rows missing a feature, recode, and add one-hot columns.

    ``levels`` maps each categorical column to its declared levels (after
    recoding). With ``rooms_as_categorical`` a ``number_of_rooms`` category
    (1..7, ``8+``) is added and one-hot encoded too.
    """
    cats = [cols.built_form, cols.property_type, cols.age_band, region]
    df = df.na.drop(how="any", subset=cats + list(numeric) + [cols.floor_area, cols.rooms])
    df = recode_categories(df, cols, region)
    lv = dict(levels)
    if rooms_as_categorical:
        df = df.withColumn("number_of_rooms", rooms_category(cols.rooms, rooms_cap))
        lv.setdefault("number_of_rooms", list(C.ROOM_CATEGORIES[: rooms_cap - 1]) + [f"{rooms_cap}+"])
    return one_hot(df, lv)


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """``(x - mean) / population std`` per column, statistics from one aggregate
    (a one-row table, broadcast)."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    j = df.crossJoin(F.broadcast(stats))
    for c in columns:
        j = j.withColumn(f"{c}{suffix}", F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")))
    return j.drop(*[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns])
