"""Queries over feature encoding and the neighbour average."""

from __future__ import annotations

from pyspark.sql import functions as F

from costlens.functions.expressions import days_since
from costlens.operators.features import dummify, one_hot, standardise
from costlens.operators.neighbours import band_topk_mean
from costlens.plans.materialise import materialise
from costlens.plans.metric_queries import rounded
from costlens.plans.registry import query
from costlens.sources.fixtures import fixture, with_fixtures
from costlens.sources.readers import read_table

DAYS_FROM = "1992-01-01"
ID_COLS = ("unit_id", "record_id", "tie_1", "tie_2", "tie_3")
ID_SQL = ", ".join(ID_COLS)


@query("band_topk_mean", with_fixtures(f"""
WITH d AS (SELECT rooms, floor_area, cost, date_diff('day', DATE '{DAYS_FROM}', event_date) AS n_days, unit_id
           FROM inst WHERE rooms IS NOT NULL AND floor_area IS NOT NULL),
qc AS (SELECT DISTINCT rooms AS qr, floor_area AS qa FROM inst WHERE rooms IS NOT NULL AND floor_area IS NOT NULL),
pairs AS (SELECT qr, qa, d.cost, d.n_days, d.unit_id FROM qc JOIN d
          ON d.rooms >= qr - 1 AND d.rooms <= qr + 1 AND d.floor_area <= qa + 50 AND d.floor_area >= qa - 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qr, qa ORDER BY n_days DESC NULLS LAST, unit_id) AS rn,
                  count(*) OVER (PARTITION BY qr, qa) AS cnt FROM pairs),
res AS (SELECT qr, qa, CASE WHEN max(cnt) > 10 THEN avg(CASE WHEN rn <= 10 THEN cost END) END AS neighbour_mean
        FROM ranked GROUP BY qr, qa)
SELECT {ID_SQL}, round(res.neighbour_mean, 4) AS neighbour_mean
FROM inst i LEFT JOIN res ON i.rooms = res.qr AND i.floor_area = res.qa
""", "inst"))
def q_band_topk_mean(spark, sf_dir):
    """Per record: mean cost of the 10 latest records within +-1 room and +-50 m2
    (whole table as both sides), null unless more than 10 such records."""
    inst = fixture(spark, sf_dir, "inst").withColumn("n_days", days_since("event_date", DAYS_FROM))
    inst = materialise(inst.select(*ID_COLS, "rooms", "floor_area", "cost", "n_days"))
    out = band_topk_mean(inst, inst, "rooms", "floor_area", "cost", "n_days", "unit_id")
    return out.select(*ID_COLS, F.round("neighbour_mean", 4).alias("neighbour_mean"))


@query("band_topk_mean_real_values", """
WITH d AS (SELECT month(o_orderdate) AS m, o_totalprice AS p, o_orderdate AS t, o_orderkey AS id FROM orders),
pairs AS (SELECT q.id AS qid, d.p, d.t, d.id FROM d q JOIN d ON d.m >= q.m - 1 AND d.m <= q.m + 1
          AND d.p <= q.p + 2500 AND d.p >= q.p - 2500),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY t DESC NULLS LAST, id) AS rn,
                  count(*) OVER (PARTITION BY qid) AS cnt FROM pairs),
res AS (SELECT qid, CASE WHEN max(cnt) > 10 THEN avg(CASE WHEN rn <= 10 THEN p END) END AS mean FROM ranked GROUP BY qid)
SELECT o_orderkey, round(mean, 4) AS neighbour_mean FROM orders LEFT JOIN res ON o_orderkey = qid
""")
def q_band_topk_mean_real_values(spark, sf_dir):
    """The same on values that hardly repeat: per order the mean total of the 10 latest orders within +-1 month
    and +-2,500 of its total, null unless more than 10 such orders."""
    orders = read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice").withColumn(
        "m", F.month("o_orderdate"))
    out = band_topk_mean(orders, orders, "m", "o_totalprice", "o_totalprice", "o_orderdate", "o_orderkey", area_band=2500.0)
    return out.select("o_orderkey", F.round("neighbour_mean", 4).alias("neighbour_mean"))


_LEVELS = {"built_form": ["Detached", "Semi-Detached", "End-Terrace", "Mid-Terrace"],
           "property_type": ["House", "Bungalow"]}


@query("one_hot", with_fixtures(f"""
SELECT {ID_SQL}, built_form, property_type, """ + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs)
    + " FROM inst", "inst"))
def q_one_hot(spark, sf_dir):
    """0/1 columns per declared level (null or undeclared value -> all zero); originals kept."""
    return one_hot(fixture(spark, sf_dir, "inst"), _LEVELS).select(
        *ID_COLS, "built_form", "property_type", *[f"{c}_{v}" for c, vs in _LEVELS.items() for v in vs])


_AGE_CASE = "CASE age_band " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in __import__("costlens.config", fromlist=["x"]).AGE_BAND_GROUPS.items()
) + " ELSE NULL END"
_ROOMS_LEVELS = ["1", "2", "3", "4", "5", "6", "7", "8+"]


@query("rooms_one_hot", with_fixtures(f"""
WITH p AS (SELECT *, 'x' AS region_name, date_diff('day', DATE '{DAYS_FROM}', event_date) AS n_days FROM inst
           WHERE built_form IS NOT NULL AND property_type IS NOT NULL AND age_band IS NOT NULL
             AND event_date IS NOT NULL AND floor_area IS NOT NULL AND rooms IS NOT NULL),
r AS (SELECT *, translate(lower({_AGE_CASE}), ' -', '__') AS age_group,
        CASE WHEN rooms >= 8 THEN '8+' WHEN rooms IN (1, 2, 3, 4, 5, 6, 7) THEN CAST(CAST(rooms AS BIGINT) AS VARCHAR) END AS number_of_rooms
      FROM p)
SELECT {ID_SQL}, age_group AS age_band, number_of_rooms, """ + ", ".join(
    [f"CASE WHEN age_group = '{v}' THEN 1 ELSE 0 END AS age_band_{v}" for v in
     ["pre_1929", "between_1930_1966", "between_1965_1983", "between_1983_2007", "2007_onwards"]]
    + [f"CASE WHEN number_of_rooms = '{v}' THEN 1 ELSE 0 END AS \"number_of_rooms_{v}\"" for v in _ROOMS_LEVELS])
    + " FROM r", "inst"))
def q_rooms_one_hot(spark, sf_dir):
    """Feature step: drop rows missing a feature, recode bands, rooms as a category (8+), one-hot."""
    inst = (fixture(spark, sf_dir, "inst").withColumn("region_name", F.lit("x"))
            .withColumn("n_days", days_since("event_date", DAYS_FROM)))
    levels = {"age_band": ["pre_1929", "between_1930_1966", "between_1965_1983", "between_1983_2007", "2007_onwards"]}
    out = dummify(inst, levels, rooms_as_categorical=True)
    return out.select(*ID_COLS, "age_band", "number_of_rooms", *[f"age_band_{v}" for v in levels["age_band"]],
                      *[f"number_of_rooms_{v}" for v in _ROOMS_LEVELS])


@query("standardise", with_fixtures(f"""
WITH s AS (SELECT avg(floor_area) AS m1, stddev_pop(floor_area) AS s1, avg(rooms) AS m2, stddev_pop(rooms) AS s2 FROM inst)
SELECT {ID_SQL}, round((floor_area - m1) / s1, 6) AS floor_area_std, round((rooms - m2) / s2, 6) AS rooms_std
FROM inst, s
""", "inst"))
def q_standardise(spark, sf_dir):
    """(x - mean) / population standard deviation per feature."""
    out = standardise(fixture(spark, sf_dir, "inst"), ["floor_area", "rooms"])
    return rounded(out.select(*ID_COLS, "floor_area_std", "rooms_std"))
