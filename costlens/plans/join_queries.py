"""Queries over outlier treatment, lookups and price-index adjustment."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.functions.expressions import cap_value
from costlens.operators import lookup as L
from costlens.operators.indexation import adjust_costs, quarterly_factors
from costlens.operators.outliers import group_distinct_rank, treat_outliers
from costlens.plans.materialise import materialise
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures

TIES = ("tie_1", "tie_2", "tie_3")
ID_COLS = ("unit_id", "record_id") + TIES
ID_SQL = "unit_id, record_id, tie_1, tie_2, tie_3"
GROUPS = ("property_type", "age_band", "rooms")
# The stand-in index series covers 1992-1998; its last whole year is the base.
FIXTURE_REF_YEAR = 1998


def _outlier_base(spark, sf_dir):
    inst = fixture(spark, sf_dir, "inst").filter(F.col("cost").isNotNull())
    return (inst.withColumn("rooms", cap_value("rooms", 8.0))
                .withColumn("cost_mirror", F.lit(25000.0) - F.col("cost"))
                # Half the rows mirrored around the lowest cost: a target with outliers on both sides.
                .withColumn("cost_two", F.when(F.col("tie_2") % 2 == 0, F.col("cost")).otherwise(F.lit(8000.0) - F.col("cost"))))


_OUTLIER_SQL = """
WITH base AS (
  SELECT * REPLACE (CASE WHEN rooms > 8 THEN 8 ELSE rooms END AS rooms), 25000 - cost AS cost_mirror,
    CASE WHEN tie_2 % 2 = 0 THEN cost ELSE 8000 - cost END AS cost_two
  FROM inst WHERE cost IS NOT NULL),
kept AS (SELECT * FROM base WHERE property_type IS NOT NULL AND age_band IS NOT NULL AND rooms IS NOT NULL),
g AS (SELECT property_type, age_band, rooms, quantile_cont({t}, 0.25) AS q1, quantile_cont({t}, 0.75) AS q3
      FROM kept GROUP BY property_type, age_band, rooms),
b AS (SELECT k.*, g.q1 - 1.5 * (g.q3 - g.q1) AS lo, g.q3 + 1.5 * (g.q3 - g.q1) AS hi
      FROM kept k JOIN g USING (property_type, age_band, rooms))
SELECT unit_id, record_id, tie_1, tie_2, tie_3, round({expr}, 4) AS {t} FROM b WHERE {cond}
"""


def _outlier_query(mode, target, expr, cond, name=None):
    sql = with_fixtures(_OUTLIER_SQL.format(t=target, expr=expr, cond=cond), "inst")

    @query(name or f"winsorise_{mode}", sql)
    def q(spark, sf_dir):
        df = materialise(_outlier_base(spark, sf_dir).select(*ID_COLS, *GROUPS, target))
        out = treat_outliers(df, GROUPS, target, mode)
        return out.select(*ID_COLS, F.round(target, 4).alias(target))

    q.__doc__ = f"Per-group IQR outlier treatment, mode '{mode}', on {target}."
    return q


_outlier_query("upper", "cost", "CASE WHEN cost > hi THEN hi ELSE cost END", "cost >= lo")
_outlier_query("none", "cost", "cost", "cost >= lo AND cost <= hi")
_outlier_query("lower", "cost_mirror", "CASE WHEN cost_mirror < lo THEN lo ELSE cost_mirror END",
               "(CASE WHEN cost_mirror < lo THEN lo ELSE cost_mirror END) <= hi")
_outlier_query("both", "cost_mirror",
               "CASE WHEN cost_mirror > hi THEN hi WHEN cost_mirror < lo THEN lo ELSE cost_mirror END", "true")


_TWO = "cost_two"
_outlier_query("upper", _TWO, "CASE WHEN cost_two > hi THEN hi ELSE cost_two END", "cost_two >= lo", "winsorise_upper_two_tailed")
_outlier_query("none", _TWO, _TWO, "cost_two >= lo AND cost_two <= hi", "winsorise_none_two_tailed")
_outlier_query("lower", _TWO, "CASE WHEN cost_two < lo THEN lo ELSE cost_two END",
               "(CASE WHEN cost_two < lo THEN lo ELSE cost_two END) <= hi", "winsorise_lower_two_tailed")
_outlier_query("both", _TWO, "CASE WHEN cost_two > hi THEN hi WHEN cost_two < lo THEN lo ELSE cost_two END", "true",
               "winsorise_both_two_tailed")


@query("group_distinct_rank", with_fixtures("""
WITH base AS (SELECT * REPLACE (CASE WHEN rooms > 8 THEN 8 ELSE rooms END AS rooms) FROM inst),
c AS (SELECT property_type, age_band, rooms, CAST(count(DISTINCT unit_id) AS BIGINT) AS n_distinct
      FROM base WHERE property_type IS NOT NULL AND age_band IS NOT NULL AND rooms IS NOT NULL
      GROUP BY property_type, age_band, rooms)
SELECT *, CAST(row_number() OVER (ORDER BY n_distinct, property_type, age_band, rooms) AS BIGINT) AS group_rank,
       'combination_' || CAST(row_number() OVER (ORDER BY n_distinct, property_type, age_band, rooms) AS VARCHAR) AS group_label
FROM c
""", "inst"))
def q_group_distinct_rank(spark, sf_dir):
    """Distinct units per (type, band, capped rooms) group, numbered by size."""
    inst = fixture(spark, sf_dir, "inst").withColumn("rooms", cap_value("rooms", 8.0))
    return group_distinct_rank(inst, GROUPS, "unit_id")


# ---------------------------------------------------------------- lookups

_REGION_SQL = """
SELECT replace(p.pcds, ' ', '') AS postcode, p.ladcd, p.ladnm, r.rgncd, r.rgnnm
FROM {p} p LEFT JOIN {r} r ON p.ladcd = r.ladcd
"""

_LOCATION_SQL = f"""
WITH n AS ({_REGION_SQL.format(p='postcode_new', r='region_new')}),
o AS ({_REGION_SQL.format(p='postcode_old', r='region_old')}),
miss AS (SELECT DISTINCT postcode FROM n WHERE rgncd IS NULL),
u AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM miss WHERE miss.postcode = n.postcode)
      UNION ALL
      SELECT * FROM o WHERE EXISTS (SELECT 1 FROM miss WHERE miss.postcode = o.postcode)),
loc AS (SELECT *, CASE substr(ladcd, 1, 1) WHEN 'E' THEN 'England' WHEN 'W' THEN 'Wales'
          WHEN 'S' THEN 'Scotland' WHEN 'N' THEN 'Northern Ireland' WHEN 'L' THEN 'Channel Islands'
          WHEN 'M' THEN 'Isle of Man' END AS country FROM u)
"""

_LOCATION_FIXTURES = ("postcode_new", "postcode_old", "region_new", "region_old")


def _locations(spark, sf_dir):
    return L.location_lookup(fixture(spark, sf_dir, "postcode_new"), fixture(spark, sf_dir, "region_new"),
                             fixture(spark, sf_dir, "postcode_old"), fixture(spark, sf_dir, "region_old"))


@query("key_normalise", with_fixtures("SELECT pcds, replace(pcds, ' ', '') AS postcode FROM postcode_new",
                                      "postcode_new"))
def q_key_normalise(spark, sf_dir):
    """Postcode key with blanks removed."""
    return L.normalise_key(fixture(spark, sf_dir, "postcode_new"), "pcds", "postcode").select("pcds", "postcode")


@query("region_lookup", with_fixtures(_REGION_SQL.format(p="postcode_new", r="region_new"),
                                      "postcode_new", "region_new"))
def q_region_lookup(spark, sf_dir):
    """Postcode -> district left-joined to district -> region."""
    regions = L.rename_positionally(fixture(spark, sf_dir, "region_new"))
    return L.district_to_region(fixture(spark, sf_dir, "postcode_new"), regions)


@query("region_lookup_fallback", with_fixtures(
    _LOCATION_SQL + "SELECT *, coalesce(rgnnm, country) AS region_name FROM loc", *_LOCATION_FIXTURES))
def q_region_lookup_fallback(spark, sf_dir):
    """Versioned lookup: keys without a region in the new version take the old
    version's rows (dropped if absent); country from the code prefix; region or country."""
    return _locations(spark, sf_dir)


@query("lookup_join", with_fixtures(
    _LOCATION_SQL + f"""
SELECT {ID_SQL}, i.postcode, loc.ladcd, coalesce(loc.rgnnm, loc.country) AS region_name
FROM inst i LEFT JOIN loc ON i.postcode = loc.postcode
""", "inst", *_LOCATION_FIXTURES))
def q_lookup_join(spark, sf_dir):
    """Left join of every record to the location lookup by postcode."""
    inst = fixture(spark, sf_dir, "inst")
    loc = _locations(spark, sf_dir).select("postcode", "ladcd", "region_name")
    return L.join_lookup(inst, loc, "postcode").select(*ID_COLS, "postcode", "ladcd", "region_name")


@query("semi_keys", with_fixtures("""
SELECT DISTINCT unit_id FROM inst
WHERE unit_id IN (SELECT unit_id FROM inst WHERE transaction_type = 'new dwelling')
""", "inst"))
def q_semi_keys(spark, sf_dir):
    """Distinct keys that have at least one new-home record (semi-join)."""
    inst = fixture(spark, sf_dir, "inst")
    flagged = inst.filter(F.col("transaction_type") == "new dwelling").select("unit_id")
    return inst.select("unit_id").distinct().join(flagged, "unit_id", "left_semi")


@query("anti_keys", with_fixtures(f"""
SELECT {ID_SQL} FROM inst i
WHERE NOT EXISTS (SELECT 1 FROM inst j WHERE j.unit_id = i.unit_id AND j.transaction_type = 'new dwelling')
""", "inst"))
def q_anti_keys(spark, sf_dir):
    """Records of keys with no new-home record (anti-join; never NOT IN)."""
    inst = fixture(spark, sf_dir, "inst")
    flagged = inst.filter(F.col("transaction_type") == "new dwelling").select("unit_id")
    return inst.join(flagged, "unit_id", "left_anti").select(*ID_COLS)


# ------------------------------------------------------------ price index

_FACTORS_SQL = f"""
factors AS (
  SELECT title, try_cast(value AS DOUBLE) AS index_value,
         1 + (ref.v - try_cast(value AS DOUBLE)) / try_cast(value AS DOUBLE) AS adjustment_factor
  FROM price_index, (SELECT min(try_cast(value AS DOUBLE)) AS v FROM price_index WHERE title = '{FIXTURE_REF_YEAR}') ref
  WHERE contains(title, 'Q'))
"""


@query("index_factors", with_fixtures(
    f"WITH {_FACTORS_SQL.strip()} SELECT title, round(index_value, 6) AS index_value, "
    "round(adjustment_factor, 8) AS adjustment_factor FROM factors", "price_index"))
def q_index_factors(spark, sf_dir):
    """Quarterly rows of the index with factors against the reference year's value."""
    f = quarterly_factors(fixture(spark, sf_dir, "price_index"), FIXTURE_REF_YEAR)
    return f.select("title", F.round("index_value", 6).alias("index_value"),
                    F.round("adjustment_factor", 8).alias("adjustment_factor"))


@query("index_adjust", with_fixtures(f"""
WITH {_FACTORS_SQL.strip()},
lab AS (SELECT *, CAST(year(event_date) AS VARCHAR) || ' Q' || CAST(quarter(event_date) AS VARCHAR) AS year_quarter FROM inst)
SELECT {ID_SQL}, year_quarter, round(f.adjustment_factor, 8) AS adjustment_factor,
       round(cost * f.adjustment_factor, 4) AS adjusted_cost
FROM lab LEFT JOIN factors f ON lab.year_quarter = f.title
""", "inst", "price_index"))
def q_index_adjust(spark, sf_dir):
    """Quarter label joined to the quarter's factor; cost scaled."""
    inst = fixture(spark, sf_dir, "inst")
    f = quarterly_factors(fixture(spark, sf_dir, "price_index"), FIXTURE_REF_YEAR)
    out = adjust_costs(inst, f, "event_date", "cost")
    return out.select(*ID_COLS, "year_quarter", F.round("adjustment_factor", 8).alias("adjustment_factor"),
                      F.round("adjusted_cost", 4).alias("adjusted_cost"))
