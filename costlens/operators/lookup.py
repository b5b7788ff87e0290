"""Lookup joins: key normalisation, district -> region, versioned fallback.

Lookup sides are not broadcast by hint: the planner broadcasts a side whose
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (adaptive
execution re-checks after each stage) and keeps a shuffle join otherwise, so
a postcode table of millions of rows still joins safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions.expressions import map_values

REGION_COLUMNS = ("ladcd", "ladnm", "rgncd", "rgnnm", "fid")


def normalise_key(df: DataFrame, source: str, out: str) -> DataFrame:
    """``out`` = ``source`` with every blank removed (postcode form)."""
    return df.withColumn(out, F.replace(F.col(source), F.lit(" "), F.lit("")))


def rename_positionally(df: DataFrame, names=REGION_COLUMNS) -> DataFrame:
    """Rename columns by position (files whose headers vary between releases)."""
    return df.toDF(*names)


def district_to_region(postcodes: DataFrame, regions: DataFrame, key_source: str = "pcds",
                       key: str = "postcode") -> DataFrame:
    """Postcode -> district rows left-joined to district -> region rows.

    Output columns: postcode, ladcd, ladnm, rgncd, rgnnm (district name from
    the postcode side).
    """
    pc = normalise_key(postcodes, key_source, key)
    rg = regions.select("ladcd", "rgncd", "rgnnm")
    return (pc.join(rg, on="ladcd", how="left")
              .select(key, "ladcd", "ladnm", "rgncd", "rgnnm"))


def fallback_union(new: DataFrame, old: DataFrame, key: str = "postcode",
                   missing_col: str = "rgncd") -> DataFrame:
    """Keys with a missing ``missing_col`` in ``new`` are replaced by their rows
    in ``old`` (and dropped if ``old`` lacks them); other keys keep ``new``."""
    missing = new.filter(F.col(missing_col).isNull()).select(key).distinct()
    kept_new = new.join(missing, on=key, how="left_anti")
    from_old = old.join(missing, on=key, how="left_semi")
    return kept_new.unionByName(from_old)


def add_country_region(df: DataFrame, code: str = "ladcd", region: str = "rgnnm",
                       country_map: dict = C.COUNTRY_BY_CODE_PREFIX) -> DataFrame:
    """``country`` from the first character of the district code (unknown or
    missing code -> null); ``region_name`` = region, else country."""
    df = df.withColumn("country", map_values(F.substring(F.col(code), 1, 1), country_map))
    return df.withColumn("region_name", F.coalesce(F.col(region), F.col("country")))


def location_lookup(postcode_new: DataFrame, region_new: DataFrame,
                    postcode_old: DataFrame, region_old: DataFrame) -> DataFrame:
    """Full versioned postcode -> region lookup with fallback and country fill."""
    new = district_to_region(postcode_new, region_new)
    old = district_to_region(postcode_old, region_old)
    return add_country_region(fallback_union(new, old))


def join_lookup(df: DataFrame, lookup: DataFrame, on: str | list, how: str = "left") -> DataFrame:
    """Left equi-join to a lookup (null keys never match)."""
    return df.join(lookup, on=on, how=how)
