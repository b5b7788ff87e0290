"""Readers by header name, and a session that leaves the master to the caller."""

import os

import pytest

from costlens import session
from costlens.sources import readers


def test_records_are_read_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "records.csv")
    names = readers.RECORD_SCHEMA.fieldNames()
    values = {"original_mcs_index": "7", "commission_date": "2020-01-02", "postcode": "AB1 2CD", "tech_type": "Air", "cost": "9000.5",
              "cluster": "true", "TOTAL_FLOOR_AREA": "81", "INSPECTION_DATE": "2019-05-06"}
    order = ["extra", *reversed(names)]
    with open(path, "w") as f:
        f.write(",".join(order) + "\n")
        f.write(",".join(values.get(n, "x" if n == "extra" else "") for n in order) + "\n")
        f.write(",".join({**values, "cost": "about 9000", "commission_date": "soon"}.get(n, "") for n in order) + "\n")
    df = readers.read_records(spark, path)
    assert df.columns == names and [f.dataType for f in df.schema] == [f.dataType for f in readers.RECORD_SCHEMA]
    good, bad = sorted(df.collect(), key=lambda r: r["cost"] is None)
    assert (good["postcode"], good["cost"], good["original_mcs_index"], str(good["commission_date"]), good["cluster"]) == (
        "AB1 2CD", 9000.5, 7, "2020-01-02", True)
    assert bad["cost"] is None and bad["commission_date"] is None and bad["postcode"] == "AB1 2CD"
    counts = {r["column"]: r["n_bad"] for r in readers.bad_cells(spark, path).collect()}
    assert {c: n for c, n in counts.items() if n} == {"cost": 1, "commission_date": 1}
    assert readers.read_records(spark, path, ["cost", "postcode"]).columns == ["cost", "postcode"]
    with pytest.raises(ValueError):
        readers.read_records(spark, path, ["cost", "no_such_column"])


def test_index_series(spark, tmp_dir):
    path = os.path.join(tmp_dir, "index.csv")
    with open(path, "w") as f:
        f.write("Title,CPI INDEX 05.3,Other\nPreUnit,,\n2015 Q1,99.1,5\n2015 Q2,100.4,6\n")
    rows = {r["title"]: r["value"] for r in readers.read_index_series(spark, path).collect()}
    assert rows["2015 Q1"] == "99.1" and rows["2015 Q2"] == "100.4" and rows["PreUnit"] is None
    named = readers.read_index_series(spark, path, value_col="Other").collect()
    assert {r["title"]: r["value"] for r in named}["2015 Q2"] == "6"


class _Builder:
    def __init__(self):
        self.masters = []

    def appName(self, _):
        return self

    def master(self, m):
        self.masters.append(m)
        return self

    def config(self, *_):
        return self

    def getOrCreate(self):
        class Context:
            def setLogLevel(self, _):
                pass

        return type("S", (), {"sparkContext": Context()})()


def test_no_master_unless_told(monkeypatch):
    builder = _Builder()
    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": builder}))
    session.get_session()
    assert builder.masters == []
    session.get_session(master="local[2]")
    assert builder.masters == ["local[2]"]
