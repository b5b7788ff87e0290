"""Hand-made edge tables for each null / tie / boundary rule."""

import datetime as dt

from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions import expressions as X
from costlens.operators import lookup as L
from costlens.operators import records as R
from costlens.operators.clean import null_out_strings, relevant_rows
from costlens.operators.features import one_hot
from costlens.operators.metrics import error_metrics, floor_metrics, interval_metrics
from costlens.operators.neighbours import band_topk_mean, block_cover
from costlens.operators.outliers import treat_outliers

D = dt.date


def test_asof_edge(spark):
    rows = [
        (1, D(2020, 1, 10), D(2020, 1, 10), 1),   # equal date counts as before
        (1, D(2020, 1, 10), D(2020, 1, 1), 2),
        (1, D(2020, 1, 10), D(2020, 2, 1), 3),
        (2, D(2020, 1, 10), D(2019, 5, 1), 1),   # only before
        (3, D(2020, 1, 10), D(2020, 3, 1), 1),   # only after -> earliest after
        (3, D(2020, 1, 10), D(2020, 2, 1), 2),
        (4, None, D(2020, 3, 1), 1),             # missing event -> earliest
        (4, None, D(2020, 2, 1), 2),
        (5, D(2020, 1, 10), D(2020, 1, 5), 2),   # same-day tie -> smallest tie key
        (5, D(2020, 1, 10), D(2020, 1, 5), 1),
    ]
    df = spark.createDataFrame(rows, "k long, ev date, rd date, t long")
    got = {r.k: (r.rd, r.t) for r in R.asof_record(df, "k", "ev", "rd", ["t"]).collect()}
    assert got == {1: (D(2020, 1, 10), 1), 2: (D(2019, 5, 1), 1), 3: (D(2020, 2, 1), 2),
                   4: (D(2020, 2, 1), 2), 5: (D(2020, 1, 5), 1)}


def test_gap_edge(spark):
    rows = [
        (1, D(2021, 1, 1), D(2020, 1, 3), "new dwelling", 1),   # gap 364 -> dropped
        (2, D(2021, 1, 1), D(2020, 1, 2), "new dwelling", 1),   # gap 365 -> kept (strict <)
        (3, D(2020, 1, 3), D(2021, 1, 1), "new dwelling", 1),   # gap -364 -> dropped
        (4, None, D(2020, 1, 1), "new dwelling", 1),            # null gap -> kept
        (5, D(2020, 6, 1), D(2020, 1, 1), "sale", 1),           # first record not new ...
        (5, D(2020, 6, 1), D(2020, 2, 1), "new dwelling", 2),   # ... second is: kept
    ]
    df = spark.createDataFrame(rows, "k long, ev date, rd date, tt string, t long")
    kept = R.exclude_new_units(df, "k", "ev", "rd", "tt", "new dwelling", 365, ["t"])
    assert sorted({r.k for r in kept.collect()}) == [2, 4, 5]


def test_winsor_edge(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 5.0)] + [("c", 7.0)] * 3 + [(None, 1e9)]
    df = spark.createDataFrame(rows, "g string, y double")
    up = {(r.g, r.y) for r in treat_outliers(df, ["g"], "y", "upper").collect()}
    # a: q1=2, q3=4, iqr=2 -> upper fence 7 (100 capped); one-row and zero-IQR groups unchanged; null group dropped
    assert up == {("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 7.0), ("b", 5.0), ("c", 7.0)}
    assert treat_outliers(df, ["g"], "y", "none").filter("g = 'a'").count() == 4
    assert treat_outliers(df, ["g"], "y", "something else").count() == 9


def test_null_out_edge(spark):
    df = spark.createDataFrame([("Unknown", "ok", 1.0), ("xUNKNOWNy", None, 2.0)], "a string, b string, n double")
    out = null_out_strings(df).collect()
    assert [tuple(r) for r in out] == [(None, "ok", 1.0), (None, None, 2.0)]


def test_relevance_keeps_null_install_type(spark):
    cols = C.Columns()
    df = spark.createDataFrame(
        [(1.0, 1, D(2020, 1, 1), "Air Source Heat Pump", None, None),
         (1.0, 2, D(2020, 1, 1), "Air Source Heat Pump", "Commercial", False),
         (1.0, 3, D(2020, 1, 1), "Air Source Heat Pump", "domestic", True)],
        f"{cols.cost} double, {cols.record_id} long, {cols.record_date} date, {cols.tech_type} string, "
        f"{cols.install_type} string, {cols.cluster} boolean")
    assert [r[cols.record_id] for r in relevant_rows(df).collect()] == [1]


def test_onehot_edge(spark):
    df = spark.createDataFrame([("x",), (None,), ("z",)], "c string")
    out = one_hot(df, {"c": ["x", "y"]}).orderBy(F.col("c").asc_nulls_first()).collect()
    assert [(r.c_x, r.c_y) for r in out] == [(0, 0), (1, 0), (0, 0)]


def test_rooms_edge(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (8.0,), (9.0,), (None,)], "r double")
    got = [r[0] for r in df.select(X.rooms_category("r")).collect()]
    assert got == ["1", "2", None, "8+", "8+", None]
    capped = [r[0] for r in df.select(X.cap_value("r", 8)).collect()]
    assert capped == [1.0, 2.0, 2.5, 8.0, 8.0, None]


def test_fallback_edge(spark):
    pnew = spark.createDataFrame([("A 1", "E1", "d1"), ("B 1", "E2", "d2"), ("C 1", "W3", "d3"),
                                  ("D 1", None, "d4")], "pcds string, ladcd string, ladnm string")
    pold = spark.createDataFrame([("B 1", "E2", "d2"), ("C 1", "W3", "d3")], "pcds string, ladcd string, ladnm string")
    rnew = spark.createDataFrame([("E1", "d1", "R1", "North", 1)], "ladcd string, ladnm string, rgncd string, rgnnm string, fid int")
    rold = spark.createDataFrame([("E1", "d1", "R1", "North", 1), ("E2", "d2", "R2", "South", 2)],
                                 "ladcd string, ladnm string, rgncd string, rgnnm string, fid int")
    got = {r.postcode: r.region_name for r in L.location_lookup(pnew, rnew, pold, rold).collect()}
    # A1 region only in new; B1 only in old; C1 in neither -> country; D1 absent from old -> dropped
    assert got == {"A1": "North", "B1": "South", "C1": "Wales"}


def test_band_edge(spark):
    # 11 neighbours within +-1 room and +-50 m2 of (3, 100): mean of the 10 latest
    data = [(3.0, 100.0 + (i % 3) * 25, float(i), i, i) for i in range(11)]
    data += [(4.0, 150.0, 100.0, 99, 20), (5.0, 100.0, 1000.0, 100, 21), (3.0, 150.1, 1000.0, 101, 22)]
    df = spark.createDataFrame(data, "r double, a double, cost double, t long, id long")
    q = spark.createDataFrame([(3.0, 100.0), (3.0, 10.0), (None, 100.0)], "r double, a double")
    out = {(x.r, x.a): x.neighbour_mean for x in band_topk_mean(q, df, "r", "a", "cost", "t", "id").collect()}
    # (4, 150) is exactly +1 room and +50 m2 -> inside; it is the latest, so the 10 latest are it + t=10..2
    assert out[(3.0, 100.0)] == (100.0 + sum(range(2, 11))) / 10
    assert out[(3.0, 10.0)] is None and out[(None, 100.0)] is None
    exactly_ten = spark.createDataFrame(data[:10], "r double, a double, cost double, t long, id long")
    assert band_topk_mean(q, exactly_ten, "r", "a", "cost", "t", "id").filter("neighbour_mean IS NOT NULL").count() == 0


def test_band_on_real_areas(spark):
    # areas with decimals of their own, a hot cell, ties, nulls, columns of clashing names
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(11)
    n = 1500
    d = pd.DataFrame({"r": rng.integers(1, 6, n) + rng.choice([0, 0.5], n, p=[0.9, 0.1]), "a": rng.uniform(20, 900, n).round(2),
                      "cost": rng.normal(50, 9, n).round(3), "t": rng.integers(0, 60, n), "id": np.arange(n)})
    d.loc[:400, ["r", "a"]] = (3.0, 222.22)
    d.loc[401:420, "a"] = 222.22 + 50
    d.loc[421:430, "a"] = 2000 + np.arange(10) * 30.01
    odd = "SELECT double(null) r, 5.0D a, 1.0D cost, 3L t, -1L id UNION ALL SELECT 3, double('NaN'), 1, 3, -2 UNION ALL SELECT 3, 222.22D, null, 99L, -3"
    df = spark.createDataFrame(d).unionByName(spark.sql(odd)).repartition(5)
    query = df.select("r", "a", F.lit("x").alias("qr"), F.lit("y").alias("mean"))
    got = band_topk_mean(query, df, "r", "a", "cost", "t", "id").collect()
    assert len(got) == n + 3 and got[0].qr == "x" and got[0].mean == "y"
    d = pd.concat([d, pd.DataFrame([(3.0, 222.22, float("nan"), 99, -3)], columns=d.columns)])
    want = {}
    for x in got:
        near = d[(d.r >= x.r - 1) & (d.r <= x.r + 1) & (d.a <= x.a + 50) & (d.a >= x.a - 50)] if x.r is not None else d[:0]
        mean = near.sort_values(["t", "id"], ascending=[False, True]).head(10)["cost"].astype(float).mean()
        want[x.r, x.a] = mean if len(near) > 10 else None
        assert (x.neighbour_mean is None) == (want[x.r, x.a] is None)
        assert want[x.r, x.a] is None or abs(x.neighbour_mean - want[x.r, x.a]) < 1e-9
    assert sum(v is not None for v in want.values()) > 500 and sum(v is None for v in want.values()) > 2
    assert band_topk_mean(query.limit(3), df.limit(0), "r", "a", "cost", "t", "id").where("neighbour_mean IS NOT NULL").count() == 0
    assert band_topk_mean(query.limit(0), df, "r", "a", "cost", "t", "id").count() == 0
    for n in (11, 16, 17, 64, 65):  # one band over all cells
        row = spark.range(n).selectExpr("2.0D AS r", "100 + id * 0.5D AS a", "double(id) AS cost", "id AS t", "id")
        mid = spark.createDataFrame([(2.0, 120.0)], "r double, a double")
        assert band_topk_mean(mid, row, "r", "a", "cost", "t", "id").first().neighbour_mean == n - 5.5


def test_band_reads_no_rows_per_query(spark, monkeypatch):
    # 4,000 queries whose bands span hundreds of cells of their own: what the tasks read grows with the rows, not with rows x blocks
    import numpy as np
    import pandas as pd

    from costlens.operators import neighbours as N

    rng = np.random.default_rng(5)
    n, read = 4000, []
    d = pd.DataFrame({"r": rng.integers(1, 4, n).astype(float), "a": rng.permutation(n) * 0.05, "cost": rng.normal(50, 9, n),
                      "t": rng.integers(0, 500, n), "id": np.arange(n)})
    df = spark.createDataFrame(d)
    made = N.bundle_rows

    def counted(*args):
        out = made(*args)
        read.append(out.groupBy("kind").count().collect())
        return out

    monkeypatch.setattr(N, "bundle_rows", counted)
    monkeypatch.setattr(N, "BUNDLE", 1 << 9)  # several bundles with cells between their fringes
    got = band_topk_mean(df, df, "r", "a", "cost", "t", "id").collect()
    kinds = {x["kind"]: x["count"] for x in read[0]}
    assert kinds[N._ASK] <= 3 * n and kinds[N._BASE] > 0 and kinds[N._FRINGE] + kinds[N._BASE] < 10 * n
    r, a, cost, order = d.r.to_numpy(), d.a.to_numpy(), d.cost.to_numpy(), np.lexsort((d.id, -d.t))
    for x in got[::37]:
        near = order[((np.abs(r - x.r) <= 1) & (np.abs(a - x.a) <= 50))[order]]
        assert abs(x.neighbour_mean - cost[near[:10]].mean()) < 1e-9


def test_blocks_cover_an_interval(spark):
    rows = [(lo, hi) for lo in range(0, 40) for hi in range(lo, 70, 3)] + [(5, 1_000_000), (0, 1 << 20)]
    df = spark.createDataFrame(rows, "lo long, hi long").select("lo", "hi", block_cover(F.col("lo"), F.col("hi"), 11).alias("c"))
    for x in df.collect():
        cells = sum(4 ** b.level for b in x.c)
        assert cells == x.hi - x.lo and len(x.c) <= 6 * 11
        spans = sorted((b.block * 4 ** b.level, (b.block + 1) * 4 ** b.level) for b in x.c)
        assert all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
        assert not spans or (spans[0][0], spans[-1][1]) == (x.lo, x.hi)


def test_interval_edge(spark):
    rows = [(10.0, 10.0, 20.0), (20.0, 10.0, 20.0), (5.0, 7000.0, 9000.0), (1.0, 7000.0, 8000.0)]
    df = spark.createDataFrame(rows, "y double, lo double, hi double")
    m = interval_metrics(df, "y", "lo", "hi").first()
    assert m.coverage == 0.5
    f = floor_metrics(df, "lo", "hi", 8000.0).first()
    assert f.lifted_width_mean == 1000.0           # only (7000, 9000) straddles; (7000, 8000) does not
    assert f.pct_lower_below == 100.0
    none = floor_metrics(df.filter("hi < 8000"), "lo", "hi", 8000.0).first()
    assert none.lifted_width_mean is None


def test_metric_edge(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0)], "y double, p double")
    m = error_metrics(df, "y", "p").first()
    assert abs(m.pct_over - 100 / 3) < 1e-9 and abs(m.pct_under - 100 / 3) < 1e-9   # equal is neither
    const = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    assert error_metrics(const, "y", "p").first().r2 is None      # constant target -> null
    empty = error_metrics(df.filter("y = p"), "y", "p").first()
    assert empty.mae_over is None and empty.mae_under is None


def test_partition_independence(spark):
    from costlens.plans.record_queries import q_asof_record
    sf = "/root/testdata/sf0.001"
    a = sorted(tuple(r) for r in q_asof_record(spark, sf).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = sorted(tuple(r) for r in q_asof_record(spark, sf).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_fixed_probability_fences(spark):
    """A6: fences from given quantiles (5 % / 90 %) instead of quartiles."""
    rows = [("a", float(v)) for v in range(1, 21)] + [("a", 1000.0)]
    df = spark.createDataFrame(rows, "g string, y double")
    out = treat_outliers(df, ["g"], "y", "none", probs=(0.05, 0.9))
    assert out.count() == 21 - 1          # only 1000 falls outside q05 - 1.5 x (q90 - q05) .. q90 + 1.5 x (...)


def test_outlier_step_only_without_cost_bounds(spark):
    """C9: with a cost bound the outlier step (and its room cap) does not run."""
    from costlens.plans.model_table import exclusion_bounds
    cols = C.Columns()
    rows = [(f"House", "1930-1949", 9.0, 100.0, float(c)) for c in [10, 11, 12, 13, 500]]
    df = spark.createDataFrame(rows, f"{cols.property_type} string, {cols.age_band} string, {cols.rooms} double, "
                                     f"{cols.floor_area} double, {cols.cost} double")
    bounded = exclusion_bounds(df, C.CleanConfig(cost_bounds=(0.0, 1e6)))
    assert sorted(r[cols.rooms] for r in bounded.collect()) == [9.0] * 5
    treated = exclusion_bounds(df, C.CleanConfig())
    got = sorted((r[cols.rooms], r[cols.cost]) for r in treated.collect())
    assert all(r == 8.0 for r, _ in got) and max(c for _, c in got) < 500.0


def test_model_table_has_no_null_features(spark):
    """M3: imputation is a no-op by construction (rows missing a feature are dropped)."""
    from costlens.plans.model_queries import FEATURES
    from costlens.plans.model_table_queries import clean_model_table
    df = clean_model_table(spark, "/root/testdata/sf0.001")
    nulls = df.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in FEATURES]).first()
    assert all(v == 0 for v in nulls)


def test_fully_tied_records_are_told_apart_by_their_values(spark):
    """Rows that tie on key, date and record id: the same row on any layout."""
    from costlens.operators.records import asof_record, first_record

    rows = [(1, "2020-01-01", "2019-05-01", 7, a, b) for a in (None, "x", "a") for b in (3.5, None, 2.0)] * 3
    df = spark.createDataFrame(rows, "k long, ev string, rd string, id long, a string, b double").selectExpr(
        "k", "date(ev) ev", "date(rd) rd", "id", "a", "b")
    for parts in (1, 2, 7):
        got = asof_record(df.repartition(parts, "a", "b"), "k", "ev", "rd", ("id",)).first()
        assert (got["a"], got["b"]) == (None, None)
        kept = first_record(df.where("a is not null and b is not null").repartition(parts), "k", "rd", ("id",)).first()
        assert (kept["a"], kept["b"]) == ("a", 2.0)
