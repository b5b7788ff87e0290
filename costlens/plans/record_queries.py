"""Queries over per-key record choice (first / last / mode / as-of / fill / exclusion)."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens import config as C
from costlens.operators import records as R
from costlens.operators.clean import null_out_strings
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures

TIES = ("tie_1", "tie_2", "tie_3")


@query("asof_record", with_fixtures("""
SELECT unit_id, record_id, event_date, inspection_date, tie_1, tie_2, tie_3 FROM (
  SELECT *, row_number() OVER (
      PARTITION BY unit_id
      ORDER BY coalesce(inspection_date <= event_date, false) DESC,
               CASE WHEN coalesce(inspection_date <= event_date, false) THEN inspection_date END DESC NULLS LAST,
               inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn
  FROM inst) t
WHERE rn = 1
""", "inst"))
def q_asof_record(spark, sf_dir):
    """Per unit: latest certificate on or before the installation, else the earliest after."""
    inst = fixture(spark, sf_dir, "inst")
    return (R.asof_record(inst, "unit_id", "event_date", "inspection_date", TIES)
            .select("unit_id", "record_id", "event_date", "inspection_date", *TIES))


@query("first_record_flag", with_fixtures("""
SELECT unit_id, event_date, inspection_date, transaction_type FROM (
  SELECT *, row_number() OVER (PARTITION BY unit_id
      ORDER BY inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn
  FROM inst) t
WHERE rn = 1 AND transaction_type = 'new dwelling'
""", "inst"))
def q_first_record_flag(spark, sf_dir):
    """Units whose first certificate (by date, missing last) marks a new home."""
    inst = fixture(spark, sf_dir, "inst")
    return R.first_record_flag(inst, "unit_id", "inspection_date", "transaction_type",
                               C.NEW_UNIT_TRANSACTION, TIES,
                               columns=["event_date", "inspection_date", "transaction_type"])


@query("last_record", with_fixtures("""
SELECT unit_id, record_id, inspection_date FROM (
  SELECT *, row_number() OVER (PARTITION BY unit_id
      ORDER BY inspection_date DESC NULLS LAST, tie_1, tie_2, tie_3) AS rn
  FROM inst) t
WHERE rn = 1
""", "inst"))
def q_last_record(spark, sf_dir):
    """Latest certificate per unit."""
    inst = fixture(spark, sf_dir, "inst")
    return R.last_record(inst, "unit_id", "inspection_date", TIES,
                         columns=["record_id", "inspection_date"])


@query("mode_per_key", with_fixtures("""
SELECT unit_id, age_band AS mode_value FROM (
  SELECT unit_id, age_band, row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, age_band ASC) AS rn
  FROM (SELECT unit_id, age_band, count(*) AS n FROM inst WHERE age_band IS NOT NULL
        GROUP BY unit_id, age_band) c) t
WHERE rn = 1
""", "inst"))
def q_mode_per_key(spark, sf_dir):
    """Most common non-null age band per unit; ties to the smallest band."""
    inst = fixture(spark, sf_dir, "inst")
    return R.mode_per_key(inst, "unit_id", "age_band")


_NULLED_INST = """
nulled AS (
  SELECT * REPLACE (
    CASE WHEN regexp_matches(age_band, '(?i)unknown') THEN NULL ELSE age_band END AS age_band,
    CASE WHEN regexp_matches(transaction_type, '(?i)unknown') THEN NULL ELSE transaction_type END AS transaction_type)
  FROM inst)
"""


@query("fill_category", with_fixtures(f"""
WITH {_NULLED_INST.strip()},
first AS (
  SELECT unit_id, transaction_type = 'new dwelling' AS is_new FROM (
    SELECT unit_id, transaction_type, row_number() OVER (PARTITION BY unit_id
        ORDER BY inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn FROM nulled) t
  WHERE rn = 1),
marked AS (
  SELECT n.* REPLACE (CASE WHEN coalesce(f.is_new, false) THEN '2007 onwards' ELSE n.age_band END AS age_band)
  FROM nulled n LEFT JOIN first f USING (unit_id)),
mode AS (
  SELECT unit_id, age_band AS mode_band FROM (
    SELECT unit_id, age_band, row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, age_band) AS rn
    FROM (SELECT unit_id, age_band, count(*) AS n FROM marked WHERE age_band IS NOT NULL GROUP BY 1, 2) c) t
  WHERE rn = 1)
SELECT m.unit_id, m.record_id, m.tie_1, m.tie_2, m.tie_3, coalesce(m.age_band, mode.mode_band) AS age_band
FROM marked m LEFT JOIN mode USING (unit_id)
""", "inst"))
def q_fill_category(spark, sf_dir):
    """Null-out unknowns, then overwrite the age band of new homes and fill
    missing bands with the unit's most common band."""
    inst = null_out_strings(fixture(spark, sf_dir, "inst"))
    out = R.fill_category(inst, "unit_id", "inspection_date", "age_band", "transaction_type",
                          C.NEW_UNIT_TRANSACTION, C.NEW_UNIT_AGE_BAND, TIES)
    return out.select("unit_id", "record_id", *TIES, "age_band")


@query("new_unit_exclusion", with_fixtures("""
WITH first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_id
        ORDER BY inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn FROM inst) t
  WHERE rn = 1),
bad AS (
  SELECT unit_id FROM first
  WHERE transaction_type = 'new dwelling' AND abs(date_diff('day', inspection_date, event_date)) < 365)
SELECT unit_id, record_id, tie_1, tie_2, tie_3 FROM inst
WHERE unit_id NOT IN (SELECT unit_id FROM bad)
""", "inst"))
def q_new_unit_exclusion(spark, sf_dir):
    """Drop units whose first certificate marks a new home within 365 days of the installation."""
    inst = fixture(spark, sf_dir, "inst")
    out = R.exclude_new_units(inst, "unit_id", "event_date", "inspection_date", "transaction_type",
                              C.NEW_UNIT_TRANSACTION, C.NEW_UNIT_GAP_DAYS, TIES)
    return out.select("unit_id", "record_id", *TIES)
