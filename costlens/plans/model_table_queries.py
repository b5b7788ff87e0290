"""The flagship query: the full clean-and-feature job on the stand-in tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from costlens import config as C
from costlens.operators import lookup as L
from costlens.operators.indexation import quarterly_factors
from costlens.plans.join_queries import _LOCATION_FIXTURES, _LOCATION_SQL, FIXTURE_REF_YEAR
from costlens.plans.model_table import model_table, units_before_features
from costlens.plans.registry import query
from costlens.plans.train_job import InputPaths, training_inputs
from costlens.session import checkpoint_dir
from costlens.sources import readers
from costlens.sources.fixtures import fixture, with_fixtures

FIXTURE_CFG = C.CleanConfig(tech_type="Air Source")

# Declared one-hot levels (after recoding) for the stand-in tables.
FIXTURE_LEVELS = {
    "built_form": ["detached", "semi_detached", "end_terrace", "mid_terrace"],
    "property_type": ["house", "bungalow"],
    "age_band": ["pre_1929", "between_1930_1966", "between_1965_1983", "between_1983_2007", "2007_onwards"],
    "region_name": ["africa", "america", "asia", "england", "scotland", "wales"],
}

OUT_COLS = ["unit_id", "record_id", "event_date", "inspection_date", "year_quarter", "n_days",
            "floor_area", "rooms", "built_form", "property_type", "age_band", "region_name"]


def fixture_inputs(spark, sf_dir):
    inst = fixture(spark, sf_dir, "inst")
    locations = L.location_lookup(
        fixture(spark, sf_dir, "postcode_new"), fixture(spark, sf_dir, "region_new"),
        fixture(spark, sf_dir, "postcode_old"), fixture(spark, sf_dir, "region_old"))
    factors = quarterly_factors(fixture(spark, sf_dir, "price_index"), FIXTURE_REF_YEAR)
    return inst, locations, factors


def dummy_names():
    return [f"{c}_{v}" for c, vs in FIXTURE_LEVELS.items() for v in vs]


def clean_model_table(spark, sf_dir):
    inst, locations, factors = fixture_inputs(spark, sf_dir)
    out = model_table(inst, locations, factors, FIXTURE_LEVELS, FIXTURE_CFG)
    return out.select(*OUT_COLS, F.round("cost", 4).alias("cost"),
                      F.round("adjusted_cost", 4).alias("adjusted_cost"), *dummy_names())


_NULL_COLS = ("postcode", "tech_type", "install_type", "age_band", "tenure", "transaction_type",
              "built_form", "property_type")

_UNITS_SQL = """
nulled AS (
  SELECT * REPLACE ({nulls}) FROM inst),
first AS (
  SELECT * FROM (SELECT unit_id, event_date, inspection_date, transaction_type,
      row_number() OVER (PARTITION BY unit_id ORDER BY inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn
    FROM nulled) t WHERE rn = 1),
flags AS (
  SELECT unit_id, coalesce(transaction_type = 'new dwelling', false) AS is_new,
         coalesce(transaction_type = 'new dwelling', false)
           AND coalesce(abs(date_diff('day', inspection_date, event_date)) < 365, false) AS drop_unit
  FROM first),
marked AS (
  SELECT n.* REPLACE (CASE WHEN f.is_new THEN '2007 onwards' ELSE n.age_band END AS age_band)
  FROM nulled n LEFT JOIN flags f USING (unit_id) WHERE NOT coalesce(f.drop_unit, false)),
mode AS (
  SELECT unit_id, age_band AS mode_band FROM (
    SELECT unit_id, age_band, row_number() OVER (PARTITION BY unit_id ORDER BY n DESC, age_band) AS rn
    FROM (SELECT unit_id, age_band, count(*) AS n FROM marked WHERE age_band IS NOT NULL GROUP BY 1, 2) c) t
  WHERE rn = 1),
filled AS (
  SELECT m.* REPLACE (coalesce(m.age_band, mode.mode_band) AS age_band) FROM marked m LEFT JOIN mode USING (unit_id)),
relevant AS (
  SELECT * FROM filled
  WHERE cost IS NOT NULL AND record_id IS NOT NULL AND inspection_date IS NOT NULL AND tech_type = 'Air Source'
    AND coalesce(lower(install_type) NOT IN ('commercial', 'non-domestic'), true) AND NOT coalesce(is_cluster, false)),
bounded AS (
  SELECT * REPLACE (CASE WHEN rooms > 8 THEN 8 ELSE rooms END AS rooms) FROM relevant
  WHERE property_type IN ('House', 'Bungalow') AND floor_area >= 20 AND floor_area <= 500),
g AS (
  SELECT property_type, age_band, rooms, quantile_cont(cost, 0.25) AS q1, quantile_cont(cost, 0.75) AS q3
  FROM bounded WHERE property_type IS NOT NULL AND age_band IS NOT NULL AND rooms IS NOT NULL
  GROUP BY property_type, age_band, rooms),
treated AS (
  SELECT b.* REPLACE (CASE WHEN b.cost > g.q3 + 1.5 * (g.q3 - g.q1) THEN g.q3 + 1.5 * (g.q3 - g.q1) ELSE b.cost END AS cost)
  FROM bounded b JOIN g USING (property_type, age_band, rooms)
  WHERE b.cost >= g.q1 - 1.5 * (g.q3 - g.q1) AND b.rooms >= 2),
factors AS (
  SELECT title, 1 + (ref.v - try_cast(value AS DOUBLE)) / try_cast(value AS DOUBLE) AS adjustment_factor
  FROM price_index, (SELECT min(try_cast(value AS DOUBLE)) AS v FROM price_index WHERE title = '{ref_year}') ref
  WHERE contains(title, 'Q')),
adjusted AS (
  SELECT t.*, CAST(year(t.event_date) AS VARCHAR) || ' Q' || CAST(quarter(t.event_date) AS VARCHAR) AS year_quarter,
         f.adjustment_factor, t.cost * f.adjustment_factor AS adjusted_cost
  FROM treated t LEFT JOIN factors f
    ON CAST(year(t.event_date) AS VARCHAR) || ' Q' || CAST(quarter(t.event_date) AS VARCHAR) = f.title),
chosen AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY unit_id
        ORDER BY coalesce(inspection_date <= event_date, false) DESC,
                 CASE WHEN coalesce(inspection_date <= event_date, false) THEN inspection_date END DESC NULLS LAST,
                 inspection_date ASC NULLS LAST, tie_1, tie_2, tie_3) AS rn
    FROM adjusted) t WHERE rn = 1)
""".format(nulls=", ".join(
    f"CASE WHEN regexp_matches({c}, '(?i)unknown') THEN NULL ELSE {c} END AS {c}" for c in _NULL_COLS),
    ref_year=FIXTURE_REF_YEAR)

_AGE_CASE = "CASE age_band " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.AGE_BAND_GROUPS.items()) + " ELSE NULL END"


def _dummy_sql():
    return ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}"
                     for c, vs in FIXTURE_LEVELS.items() for v in vs)


_CLEAN_SQL = with_fixtures(
    _LOCATION_SQL.rstrip() + ",\n" + _UNITS_SQL.strip() + f""",
joined AS (
  SELECT c.*, coalesce(loc.rgnnm, loc.country) AS region_name,
         CAST(date_diff('day', DATE '{C.MIN_DATE}', c.event_date) AS BIGINT) AS n_days
  FROM chosen c LEFT JOIN loc ON c.postcode = loc.postcode),
present AS (
  SELECT * FROM joined WHERE built_form IS NOT NULL AND property_type IS NOT NULL AND age_band IS NOT NULL
    AND region_name IS NOT NULL AND n_days IS NOT NULL AND floor_area IS NOT NULL AND rooms IS NOT NULL),
recoded AS (
  SELECT * REPLACE (
    translate(lower(CASE WHEN contains(built_form, 'End-Terrace') THEN 'End-Terrace'
                         WHEN contains(built_form, 'Mid-Terrace') THEN 'Mid-Terrace' ELSE built_form END), ' -', '__') AS built_form,
    translate(lower(property_type), ' -', '__') AS property_type,
    translate(lower({_AGE_CASE}), ' -', '__') AS age_band,
    translate(lower(region_name), ' -', '__') AS region_name)
  FROM present)
SELECT {", ".join(OUT_COLS)}, round(cost, 4) AS cost, round(adjusted_cost, 4) AS adjusted_cost, {_dummy_sql()}
FROM recoded
""", "inst", "price_index", *_LOCATION_FIXTURES)


@query("clean_model_table", _CLEAN_SQL)
def q_clean_model_table(spark, sf_dir):
    """Full job: null-out, age-band fill, new-unit exclusion, relevance filter,
    bounds + per-group winsorising, price-index adjustment, as-of certificate
    choice, location lookup, days since start, one-hot features."""
    return clean_model_table(spark, sf_dir)


_UNITS_ONLY_SQL = with_fixtures("WITH " + _UNITS_SQL.strip() + """
SELECT unit_id, record_id, event_date, inspection_date, rooms, round(cost, 4) AS cost,
       round(adjusted_cost, 4) AS adjusted_cost FROM chosen
""", "inst", "price_index")


@query("units_before_features", _UNITS_ONLY_SQL)
def q_units_before_features(spark, sf_dir):
    """The job up to the as-of certificate choice (one row per unit, before lookups and features)."""
    inst, _, factors = fixture_inputs(spark, sf_dir)
    out = units_before_features(inst, factors, FIXTURE_CFG)
    return out.select("unit_id", "record_id", "event_date", "inspection_date", "rooms",
                      F.round("cost", 4).alias("cost"), F.round("adjusted_cost", 4).alias("adjusted_cost"))


# The stand-in rows under the source's column names, with one more column in front as wider files have.
_LANDED = ("'x' AS extra_column", "INSPECTION_DATE AS INSPECTION_DATE", "unit_id AS original_mcs_index", "event_date AS commission_date",
           "postcode", "tech_type", "cost", "is_cluster AS cluster", "record_id AS original_epc_index",
           "install_type AS installation_type", "floor_area AS TOTAL_FLOOR_AREA", "age_band AS CONSTRUCTION_AGE_BAND",
           "rooms AS NUMBER_HABITABLE_ROOMS", "tenure AS TENURE", "transaction_type AS TRANSACTION_TYPE",
           "built_form AS BUILT_FORM", "property_type AS PROPERTY_TYPE")
SOURCE_FIXTURE_CFG = replace(C.SOURCE_CONFIG, tech_type="Air Source")
SOURCE_LEVELS = {{"built_form": "BUILT_FORM", "property_type": "PROPERTY_TYPE", "age_band": "CONSTRUCTION_AGE_BAND"}.get(c, c): v
                 for c, v in FIXTURE_LEVELS.items()}
_SOURCE_OUT = {"unit_id": "original_mcs_index", "record_id": "original_epc_index", "event_date": "commission_date",
               "inspection_date": "INSPECTION_DATE", "floor_area": "TOTAL_FLOOR_AREA", "rooms": "NUMBER_HABITABLE_ROOMS",
               "built_form": "BUILT_FORM", "property_type": "PROPERTY_TYPE", "age_band": "CONSTRUCTION_AGE_BAND"}


def land_files(spark, sf_dir, folder):
    """The stand-in tables as the job's input files."""
    views = {"records": fixture(spark, sf_dir, "inst").selectExpr(*_LANDED),
             "price_index": fixture(spark, sf_dir, "price_index").withColumnsRenamed({"title": "Title", "value": "CPI"})}
    views |= {n: fixture(spark, sf_dir, n) for n in _LOCATION_FIXTURES}
    for name, df in views.items():
        df.write.option("header", True).option("encoding", "ISO-8859-1" if "postcode" in name else "UTF-8").csv(f"{folder}/{name}")
    return InputPaths(**{n: f"{folder}/{n}" for n in views})


def _source_ties(sql):
    """The source's tie rule (record id) and then the row's own values, nulls first, in both record choices."""
    rest = {"nulled": ("event_date", "inspection_date", "transaction_type"),
            "adjusted": ("event_date", "postcode", "cost", "record_id", "floor_area", "age_band", "rooms", "built_form", "property_type")}
    for table, columns in rest.items():
        order = ", ".join(f"{c} ASC NULLS FIRST" for c in ("record_id", *columns))
        sql = sql.replace(f"tie_1, tie_2, tie_3) AS rn\n    FROM {table})", f"{order}) AS rn\n    FROM {table})")
    return sql


# The oracle is the flagship's, with the source's tie rule and names.
_TRAIN_SQL = _source_ties(_CLEAN_SQL)
_TRAIN_NAMES = ", ".join([f"{c} AS {_SOURCE_OUT[c]}" if c in _SOURCE_OUT else c for c in OUT_COLS] + ["cost", "adjusted_cost"] + [
    f"{c}_{v} AS {_SOURCE_OUT.get(c, c)}_{v}" for c, vs in FIXTURE_LEVELS.items() for v in vs])


@query("train_inputs", f"SELECT {_TRAIN_NAMES} FROM ({_TRAIN_SQL})")
def q_train_inputs(spark, sf_dir):
    """The training job's model table from landed CSV files with the source's column names."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    out = training_inputs(spark, land_files(spark, sf_dir, folder), SOURCE_LEVELS, SOURCE_FIXTURE_CFG, FIXTURE_REF_YEAR)
    dummies = [f"{c}_{v}" for c, vs in SOURCE_LEVELS.items() for v in vs]
    return out.select(*[_SOURCE_OUT.get(c, c) for c in OUT_COLS], F.round("cost", 4).alias("cost"),
                      F.round("adjusted_cost", 4).alias("adjusted_cost"), *dummies)


_SCAN_COLS = ("original_mcs_index", "commission_date", "INSPECTION_DATE", "cost", "TOTAL_FLOOR_AREA", "PROPERTY_TYPE")


@query("scan_projection", with_fixtures("""
SELECT unit_id AS original_mcs_index, event_date AS commission_date, inspection_date AS "INSPECTION_DATE", round(cost, 4) AS cost,
       CAST(floor_area AS DOUBLE) AS "TOTAL_FLOOR_AREA", property_type AS "PROPERTY_TYPE" FROM inst
""", "inst"))
def q_scan_projection(spark, sf_dir):
    """A few columns of the landed records, read by header name with their types and dates."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    rows = readers.read_records(spark, land_files(spark, sf_dir, folder).records).select(*_SCAN_COLS)
    return rows.withColumn("cost", F.round("cost", 4))


@query("index_file", with_fixtures("""
SELECT title, CAST(value AS VARCHAR) AS value FROM price_index WHERE title IS NOT NULL
""", "price_index"))
def q_index_file(spark, sf_dir):
    """The price index series from its landed file."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    return readers.read_index_series(spark, land_files(spark, sf_dir, folder).price_index)
