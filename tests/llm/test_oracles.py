"""Every query with SQL against DuckDB on the smallest tables; the others run and return their whole table."""

import os

import duckdb
import pytest

from costlens.llm import queries as Q
from tools.check_oracle import compare

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    df = Q.QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(Q.ORACLES[name])
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) == "ok"


def test_all_thirteen_are_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


@pytest.mark.parametrize("name, table", [("op3_language", "documents"), ("op4_html", "pages"), ("op8_sharding", "documents"),
                                         ("op10_quality", "documents"), ("op11_toxicity", "documents"),
                                         ("op13_merkle", "documents")])
def test_one_row_for_each_row_of_the_table(spark, sf, name, table):
    assert Q.QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
