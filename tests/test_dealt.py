"""Rows dealt by key: tasks grow in number with the rows, and the groups stay the same."""

from pyspark.sql import functions as F

from costlens.operators import outliers, records
from costlens.plans import materialise as M


def test_tasks_grow_with_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    assert M.dealt(df, "k", rows_a_task=100).rdd.getNumPartitions() == 10
    assert M.dealt(df.limit(0), "k").rdd.getNumPartitions() == 1 and M.dealt(df, "k", "id").count() == 1000


def test_mode_and_distinct_rank_over_many_tasks(spark, monkeypatch):
    dealt, seen = M.dealt, []

    def few(df, *keys):
        seen.append(keys)
        return dealt(df, *keys, rows_a_task=3)

    monkeypatch.setattr(records, "dealt", few)
    monkeypatch.setattr(outliers, "dealt", few)
    rows = [(1, "b", 5), (1, "a", 5), (1, None, 6), (2, None, 7), (None, "c", 8), (None, "c", None), (3, "z", 1), (3, "z", 1), (3, "a", 2)]
    df = spark.createDataFrame(rows, "k long, v string, u long")
    got = {(r["k"], r["mode_value"]) for r in records.mode_per_key(df, "k", "v").collect()}
    assert got == {(1, "a"), (None, "c"), (3, "z")}
    ranked = [(r["k"], r["v"], r["n_distinct"], r["group_rank"]) for r in
              outliers.group_distinct_rank(df, ["k", "v"], "u").orderBy("group_rank").collect()]
    assert ranked == [(1, "a", 1, 1), (1, "b", 1, 2), (3, "a", 1, 3), (3, "z", 1, 4)]
    assert [r["n_distinct"] for r in outliers.group_distinct_rank(df, ["v"], "u").orderBy("v").collect()] == [2, 1, 1, 1]
    assert seen[:2] == [("k", "v"), ("k",)]
