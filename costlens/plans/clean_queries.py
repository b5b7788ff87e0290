"""Queries over cleaning filters and scalar feature functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions import expressions as X
from costlens.operators.clean import (allow_list, bounds_filter, drop_null_rows, null_out_strings,
                                      relevant_rows, share_over_threshold)
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures

TIES = ("tie_1", "tie_2", "tie_3")
ID_COLS = ("unit_id", "record_id") + TIES
ID_SQL = "unit_id, record_id, tie_1, tie_2, tie_3"
# The stand-in table labels its kept technology "Air Source".
FIXTURE_TECH = "Air Source"
STRING_COLS = ("postcode", "tech_type", "install_type", "age_band", "tenure", "transaction_type",
               "built_form", "property_type")


def _inst(spark, sf_dir):
    return fixture(spark, sf_dir, "inst")


def _null_sql(c):
    return f"CASE WHEN regexp_matches({c}, '(?i)unknown') THEN NULL ELSE {c} END AS {c}"


@query("null_out_regex", with_fixtures(
    f"SELECT {ID_SQL}, floor_area, " + ", ".join(_null_sql(c) for c in STRING_COLS) + " FROM inst",
    "inst"))
def q_null_out_regex(spark, sf_dir):
    """Every string cell containing "unknown" (any case) becomes null; numbers untouched."""
    return null_out_strings(_inst(spark, sf_dir)).select(*ID_COLS, "floor_area", *STRING_COLS)


@query("drop_null_keys", with_fixtures(f"""
SELECT {ID_SQL} FROM inst WHERE cost IS NOT NULL AND record_id IS NOT NULL AND inspection_date IS NOT NULL
""", "inst"))
def q_drop_null_keys(spark, sf_dir):
    """Drop rows missing cost, record id or record date."""
    return drop_null_rows(_inst(spark, sf_dir), ["cost", "record_id", "inspection_date"]).select(*ID_COLS)


@query("relevant_rows", with_fixtures(f"""
SELECT {ID_SQL} FROM inst
WHERE cost IS NOT NULL AND record_id IS NOT NULL AND inspection_date IS NOT NULL
  AND tech_type = 'Air Source'
  AND coalesce(lower(install_type) NOT IN ('commercial', 'non-domestic'), true)
  AND NOT coalesce(is_cluster, false)
""", "inst"))
def q_relevant_rows(spark, sf_dir):
    """Relevance filter: keys present, technology, installation type deny-list (nulls kept), no cluster."""
    return relevant_rows(_inst(spark, sf_dir), C.Columns(), tech_type=FIXTURE_TECH).select(*ID_COLS)


@query("exclusion_bounds", with_fixtures(f"""
SELECT {ID_SQL}, rooms, round(cost, 4) AS cost FROM inst
WHERE property_type IN ('House', 'Bungalow') AND floor_area >= 20 AND floor_area <= 500
  AND cost >= 3500 AND cost <= 25000 AND rooms >= 2
""", "inst"))
def q_exclusion_bounds(spark, sf_dir):
    """Allow-list plus optional inclusive bounds (a cost bound is given, so no outlier step)."""
    from costlens.plans.model_table import exclusion_bounds
    cfg = C.CleanConfig(cost_bounds=(3500.0, 25000.0))
    out = exclusion_bounds(_inst(spark, sf_dir), cfg)
    return out.select(*ID_COLS, "rooms", F.round("cost", 4).alias("cost"))


@query("cap_value", with_fixtures(f"""
SELECT {ID_SQL}, CASE WHEN rooms > 8 THEN 8 ELSE rooms END AS rooms_capped FROM inst
""", "inst"))
def q_cap_value(spark, sf_dir):
    """Cap room count at 8 keeping nulls."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.cap_value("rooms", 8.0).alias("rooms_capped"))


@query("share_over_threshold", with_fixtures("""
SELECT property_type, CAST(count_if(coalesce(rooms >= 8, false)) AS BIGINT) AS n_over,
       CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(CASE WHEN coalesce(rooms >= 8, false) THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS pct_over
FROM inst GROUP BY property_type
""", "inst"))
def q_share_over_threshold(spark, sf_dir):
    """Count and share of rows with 8 or more rooms, per property type."""
    return share_over_threshold(_inst(spark, sf_dir), "rooms", 8, by=["property_type"])


@query("days_since", with_fixtures(f"""
SELECT {ID_SQL}, CAST(date_diff('day', DATE '2007-01-01', event_date) AS BIGINT) AS n_days FROM inst
""", "inst"))
def q_days_since(spark, sf_dir):
    """Days from the fixed start date to the installation date."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.days_since("event_date", C.MIN_DATE).alias("n_days"))


@query("quarter_label", with_fixtures(f"""
SELECT {ID_SQL}, CAST(year(event_date) AS VARCHAR) || ' Q' || CAST(quarter(event_date) AS VARCHAR) AS year_quarter
FROM inst
""", "inst"))
def q_quarter_label(spark, sf_dir):
    """`YYYY Qn` label per row (null date -> null)."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.quarter_label("event_date").alias("year_quarter"))


_AGE_CASE = "CASE age_band " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.AGE_BAND_GROUPS.items()) + " ELSE NULL END"


@query("recode_category", with_fixtures(f"SELECT {ID_SQL}, {_AGE_CASE} AS age_group FROM inst", "inst"))
def q_recode_category(spark, sf_dir):
    """Twelve age bands to five groups; unlisted bands -> null."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.map_values("age_band", C.AGE_BAND_GROUPS).alias("age_group"))


@query("collapse_category", with_fixtures(f"""
SELECT {ID_SQL}, CASE WHEN contains(built_form, 'End-Terrace') THEN 'End-Terrace'
                      WHEN contains(built_form, 'Mid-Terrace') THEN 'Mid-Terrace'
                      ELSE built_form END AS built_form
FROM inst
""", "inst"))
def q_collapse_category(spark, sf_dir):
    """(Enclosed) End-/Mid-Terrace collapsed to End-Terrace / Mid-Terrace."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.collapse_built_form("built_form").alias("built_form"))


@query("normalise_text", with_fixtures(f"""
SELECT {ID_SQL}, translate(lower(built_form), ' -', '__') AS built_form,
       translate(lower(transaction_type), ' -', '__') AS transaction_type FROM inst
""", "inst"))
def q_normalise_text(spark, sf_dir):
    """Lower-case; blanks and hyphens to underscores."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.normalise_text("built_form").alias("built_form"),
                                       X.normalise_text("transaction_type").alias("transaction_type"))


@query("rooms_category", with_fixtures(f"""
SELECT {ID_SQL}, CASE WHEN rooms >= 8 THEN '8+'
                      WHEN rooms IN (1, 2, 3, 4, 5, 6, 7) THEN CAST(CAST(rooms AS BIGINT) AS VARCHAR)
                      ELSE NULL END AS number_of_rooms
FROM (SELECT * REPLACE (rooms + CASE WHEN tie_1 = 3 THEN 0.5 ELSE 0 END AS rooms) FROM inst) t
""", "inst"))
def q_rooms_category(spark, sf_dir):
    """Room count as category 1..7 / 8+; non-whole counts (half rooms added on every 3rd line) null."""
    inst = _inst(spark, sf_dir).withColumn(
        "rooms", F.col("rooms") + F.when(F.col("tie_1") == 3, F.lit(0.5)).otherwise(F.lit(0.0)))
    return inst.select(*ID_COLS, X.rooms_category("rooms").alias("number_of_rooms"))


@query("rule_table_estimate", with_fixtures(f"""
SELECT {ID_SQL}, CASE
  WHEN property_type = 'Bungalow' THEN CASE rooms WHEN 2 THEN 9900 WHEN 3 THEN 10650 WHEN 4 THEN 11950
       WHEN 5 THEN 12780 WHEN 6 THEN 13710 WHEN 7 THEN 14480 END
  WHEN property_type <> 'Bungalow' AND built_form = 'Detached' THEN CASE rooms WHEN 4 THEN 12640 WHEN 5 THEN 13210
       WHEN 6 THEN 13800 WHEN 7 THEN 14370 WHEN 8 THEN 15150 END
  WHEN property_type <> 'Bungalow' AND built_form <> 'Detached' THEN CASE rooms WHEN 3 THEN 10850 WHEN 5 THEN 11380
       WHEN 6 THEN 12850 WHEN 7 THEN 14070 END
  END::DOUBLE AS predicted_cost
FROM inst
""", "inst"))
def q_rule_table_estimate(spark, sf_dir):
    """Rule-table price by (bungalow?, rooms, detached?); first matching rule wins."""
    inst = _inst(spark, sf_dir)
    return inst.select(*ID_COLS, X.rule_table_estimate(F.col("property_type") == "Bungalow", "rooms",
                                                       F.col("built_form") == "Detached")
                       .alias("predicted_cost"))


@query("date_weights", with_fixtures(f"""
SELECT {ID_SQL}, CAST(CASE WHEN coalesce(event_date >= DATE '1996-01-01', false) THEN 2.0 ELSE 1.0 END AS DOUBLE) AS weight FROM inst
""", "inst"))
def q_date_weights(spark, sf_dir):
    """Sample weight 2 from a date on, else 1."""
    return _inst(spark, sf_dir).select(*ID_COLS, X.date_weight("event_date", "1996-01-01").alias("weight"))
