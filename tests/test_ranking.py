"""Exact row numbers without a global window."""

import random

import pytest
from pyspark.sql import functions as F

from costlens.operators.ranking import exact_rank, free_names


def brute(rows):
    """(g, v) rows with their 0-based place in g and g's size."""
    key = lambda v: (v is not None, v or 0)
    out = []
    for g in {g for g, _ in rows}:
        vs = sorted((v for h, v in rows if h == g), key=key)
        out += [(g, v, i, len(vs)) for i, v in enumerate(vs)]
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_ranks_in_groups_with_nulls_and_ties(spark, parts):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b", ""]), rng.choice([None, *range(20)])) for _ in range(400)] + [("hot", 3)] * 700
    df = spark.createDataFrame(rows, "g string, v int").repartition(parts)
    got = [tuple(r) for r in exact_rank(df, ["v"], ["g"], out="at", total="n").collect()]
    assert sorted(got, key=str) == brute(rows)


def test_whole_table_descending_and_clashing_names(spark):
    df = spark.createDataFrame([(i * 7 % 50, "x") for i in range(50)], "_at int, _part string")
    got = {r["_at"]: r["rank"] for r in exact_rank(df, [-F.col("_at")]).collect()}
    assert got == {i: 49 - i for i in range(50)}


def test_empty_table(spark):
    assert exact_rank(spark.createDataFrame([], "v int"), ["v"]).collect() == []


def test_free_names():
    assert free_names(["A", "b_"], "a", "b", "a") == ["a_", "b", "a__"]
