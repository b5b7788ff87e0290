"""Exact distributed quantiles against numpy, with groups far larger than the sketch."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from costlens.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    big = np.concatenate([rng.lognormal(8, 2, 9000), np.full(3000, 77.0)])
    small = [("b", x) for x in rng.normal(size=7)] + [("c", 4.0), ("d", None), ("d", None), (None, 1.0), (None, 2.0), ("b", None)]
    return pd.DataFrame([("a", float(x)) for x in big] + small, columns=["g", "v"])


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_like_numpy(spark, rows, accuracy):
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(g, None if v != v else v) for g, v in rows.itertuples(index=False)], "g string, v double").repartition(7)
    lin = {r["g"]: list(r)[1:] for r in exact_quantiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    low = {r["g"]: list(r)[1:] for r in exact_quantiles(df, ["g"], "v", probs, "lower", accuracy).collect()}
    assert lin["d"] == low["d"] == [None] * len(probs)
    for g in ("a", "b", "c", None):
        v = rows[rows.g.isna() if g is None else rows.g == g].v.dropna().to_numpy()
        assert np.allclose(lin[g], np.quantile(v, probs), rtol=1e-12)
        assert np.allclose(low[g], np.quantile(v, probs, method="inverted_cdf"), rtol=0)


def test_whole_table_empty_and_order(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert list(exact_quantiles(df, [], "v", [0.1, 0.5], accuracy=50).first()) == [100.0, 500.0]
    assert exact_quantiles(df.where("v < 0"), ["v"], "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "v", [0.5, 0.1])


def test_a_hot_group_is_not_gathered(spark):
    """Of a group with nine tenths of the rows only the values near the wanted rank are gathered."""
    df = spark.range(100_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(0)).alias("g"),
                                     F.xxhash64("id").cast("double").alias("v"))
    plan = exact_quantiles(df, ["g"], "v", [0.5], accuracy=1000)
    assert "percentile(" not in plan._jdf.queryExecution().executedPlan().toString()
    exact = df.where("g = 0").agg(F.percentile("v", 0.5)).first()[0]
    assert plan.where("g = 0").first()["q0"] == exact


def test_weighted_quantiles_against_a_loop(spark):
    import numpy as np
    import pandas as pd

    from costlens.operators.quantiles import weighted_quantiles

    rng = np.random.default_rng(8)
    d = pd.DataFrame({"g": rng.choice(["a", "b", "hot"], 3000, p=[0.1, 0.1, 0.8]), "v": rng.normal(0, 5, 3000).round(2), "w": rng.integers(0, 4, 3000)})
    d.loc[d.index % 50 == 0, "v"] = np.nan
    df = spark.createDataFrame(d).selectExpr("nullif(g, 'b') AS g", "nullif(v, double('nan')) AS v", "w").repartition(5)
    df = df.unionByName(spark.createDataFrame([("none", None, 1), ("none", 2.0, 0), ("one", 4.0, 2)], df.schema))
    probs = [0.0, 0.1, 0.5, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(4)] for r in weighted_quantiles(df, ["g"], "v", "w", probs).collect()}
    assert set(got) == {"a", None, "hot", "one"} and got["one"] == [4.0] * 4
    for g, name in (("a", "a"), (None, "b"), ("hot", "hot")):
        part = d[(d.g == name) & d.v.notna() & (d.w > 0)].sort_values("v")
        sums = part.w.cumsum().to_numpy()
        assert got[g] == [part.v.to_numpy()[np.searchsorted(sums, p * sums[-1] * (1 - 1e-12))] for p in probs]
    whole = weighted_quantiles(df, [], "v", "w", [0.5]).first()["q0"]
    part = d[d.v.notna() & (d.w > 0)].sort_values("v")
    assert abs(whole - part.v.to_numpy()[np.searchsorted(part.w.cumsum(), 0.5 * part.w.sum())]) < 0.05


def test_equal_folds(spark):
    from costlens.operators.split import assign_equal_folds

    df = spark.range(103).selectExpr("nullif(id, 5) AS k").repartition(6)
    folds = assign_equal_folds(df, "k", 5)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == [20, 20, 21, 21, 21]
    again = assign_equal_folds(df.repartition(2), "k", 5)
    assert sorted(map(str, folds.collect())) == sorted(map(str, again.collect()))


def test_many_ranks_row_by_row(spark):
    import numpy as np
    import pandas as pd

    from costlens.operators.quantiles import exact_quantiles, ranked_quantiles

    rng = np.random.default_rng(5)
    d = pd.DataFrame({"g": rng.choice(["a", "hot"], 4000, p=[0.2, 0.8]), "v": np.r_[rng.normal(0, 9, 3000), np.full(1000, 1.5)]})
    df = spark.createDataFrame(d).repartition(6).selectExpr("nullif(g, 'a') AS g", "v").unionByName(
        spark.createDataFrame([("none", None), ("one", 3.0)], "g string, v double"))
    probs = [i / 50 for i in range(51)]
    got = {(r["g"], r["i"]): r["q"] for r in ranked_quantiles(df, ["g"], "v", probs).collect()}
    assert {g for g, _ in got} == {None, "hot", "one"} and len(got) == 3 * 51
    for name, g in (("a", None), ("hot", "hot")):
        assert np.allclose([got[g, i] for i in range(51)], np.quantile(d.v[d.g == name], probs))
    assert set(got["one", i] for i in range(51)) == {3.0}
    whole = {r["i"]: r["q"] for r in ranked_quantiles(df, [], "v", probs).collect()}
    other = exact_quantiles(df, [], "v", probs).first()
    assert np.allclose([whole[i] for i in range(51)], list(other))
    assert ranked_quantiles(df.limit(0), [], "v", probs).collect() == []


def test_rows_are_neither_sorted_nor_shuffled_by_their_group(spark):
    from costlens.operators.explore import box_stats

    df = spark.range(60_000).select((F.col("id") % 2).cast("string").alias("g"), F.xxhash64("id").cast("double").alias("v"))
    plan = exact_quantiles(df, ["g"], "v", [0.25, 0.75])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    plan = box_stats(df, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "BroadcastHashJoin" in plan
