"""Disk that long jobs hold: written tables that nothing reads any more go, and the rows of the records are dealt out once."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from costlens.models.quantile_boost import BoostBatch
from costlens.models.tree_growth import Spec
from costlens.plans import materialise as M
from costlens.session import checkpoint_dir
from costlens.sources.fixtures import fixture


def tables(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(folder) if d.startswith("table-")}


def test_a_batch_keeps_one_table_however_often_it_is_written(spark):
    n = 400
    d = pd.DataFrame({"a": np.arange(n) % 37.0, "y": np.arange(n) % 37 + np.sin(np.arange(n))})
    before = tables(spark)
    batch = BoostBatch(spark.createDataFrame(d), ["a"], "y", [Spec(0.5, 6, 2)], ["a"], local_rows=0, rewrite_every=1)
    batch.advance(4)
    assert len(tables(spark) - before) == 1
    given = batch.predictions()  # its files stay while the batch goes on
    want = sorted(r["pred"][0] for r in given.collect())
    batch.advance(6)
    assert len(tables(spark) - before) == 2
    batch.close()
    assert len(tables(spark) - before) == 1 and sorted(r["pred"][0] for r in given.collect()) == want
    assert np.allclose(sorted(batch.models[0].predict_numpy(d[["a"]].to_numpy()))[0], min(want), atol=5)


def test_a_closed_batch_leaves_no_table(spark):
    d = pd.DataFrame({"a": np.arange(100) % 7.0, "y": np.arange(100.0)})
    before = tables(spark)
    batch = BoostBatch(spark.createDataFrame(d), ["a"], "y", [Spec(0.5, 3, 2)])
    batch.advance(3)
    batch.close()
    assert tables(spark) == before


def written(spark, folder):
    """The tables that the records read, with parts and customers that repeat or are missing."""
    rng, n = np.random.default_rng(5), 300
    lineitem = pd.DataFrame({"l_orderkey": rng.integers(0, 80, n), "l_partkey": rng.integers(0, 40, n), "l_suppkey": rng.integers(0, 9, n),
                             "l_linenumber": rng.integers(1, 8, n), "l_quantity": rng.integers(1, 50, n).astype(float),
                             "l_returnflag": rng.choice(["N", "A", "R"], n), "l_shipdate": pd.Timestamp("1995-03-01")})
    orders = pd.DataFrame({"o_orderkey": np.append(np.arange(70), 5), "o_custkey": rng.integers(0, 30, 71), "o_orderstatus": "O",
                           "o_totalprice": rng.uniform(1e3, 4e5, 71), "o_orderdate": pd.Timestamp("1995-02-01"), "o_orderpriority": "5-LOW"})
    part = pd.DataFrame({"p_partkey": np.append(np.arange(35), 3), "p_size": rng.integers(1, 50, 36), "p_type": "ECONOMY"})
    customer = pd.DataFrame({"c_custkey": np.append(np.arange(25), 4), "c_mktsegment": rng.choice(["A", "B"], 26)})
    for name, d in (("lineitem", lineitem), ("orders", orders), ("part", part), ("customer", customer)):
        spark.createDataFrame(d).write.parquet(f"{folder}/{name}.parquet")


def test_records_keep_their_rows_and_come_dealt_by_unit(spark, tmp_dir):
    from costlens.sources import fixtures

    written(spark, tmp_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inst = fixture(spark, tmp_dir, "inst")
        asked = spark.sql(fixtures.FIXTURE_SQL["inst"])
        assert inst.exceptAll(asked).count() == 0 and asked.exceptAll(inst).count() == 0 and inst.count() > 100
        shuffles = [df.groupBy("unit_id").agg(F.count("age_band"))._jdf.queryExecution().executedPlan().toString().count("Exchange hash")
                    for df in (inst, asked)]
        assert shuffles == [6, 7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_release_deletes_the_shuffles_of_finished_steps(spark):
    from pathlib import Path
    from time import sleep

    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])

    def files():
        return {p for p in local.rglob("shuffle_*.data")}

    M.release(spark)
    sleep(1)
    before = files()
    M.materialise(spark.range(1000).repartition(3, "id"))
    made = files() - before
    for _ in range(50):  # Spark deletes them in the background
        M.release(spark)
        sleep(0.2)
        if not made & files():
            break
    assert made and not made & files()
