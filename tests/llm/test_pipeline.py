"""The pipeline, stage by stage against brute force over each stage's own input."""

import sys
from pathlib import Path

import corpus_pipeline
from costlens.llm import queries as Q
from costlens.llm.common import stash, table

sys.path.insert(0, str(Path(__file__).parent))
from test_decontaminate import brute as brute_contamination  # noqa: E402
from test_near_dup import shingles  # noqa: E402


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, rows = docs.columns, {}
    extra = spark.createDataFrame([(900_001, None, None, None, None), (900_002, "", "en", "x", 0), (None, "the same of a short text", "en", "y", 5)], docs.schema)
    docs = docs.unionByName(extra)
    rows["start"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, sf), name)
        rows[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "decontamination", "packing"]

    texts = lambda rs: [r["text"] for r in rs]
    start = table(spark, sf, "documents").unionByName(extra)
    score = Q.quality_model(start, table(spark, sf, "labels")).judge(texts(rows["start"]))
    assert sorted(map(str, (r for r, s in zip(rows["start"], score) if s >= 0.7))) == sorted(map(str, rows["quality"]))
    judged = Q.language_model(spark.createDataFrame(rows["quality"], start.schema)).judge(texts(rows["quality"]))
    assert sorted(map(str, (r for r, x in zip(rows["quality"], judged["rejected"]) if not x))) == sorted(map(str, rows["language"]))

    given = [r for r in rows["language"] if r["doc_id"] is not None]
    sets = [shingles(r["text"]) for r in given]
    comp = list(range(len(given)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(given)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda k: given[k]["doc_id"])
                comp[b] = a
    keep = sorted(str(r) for i, r in enumerate(given) if find(i) == i)
    assert keep == sorted(str(r) for r in rows["near_dedup"] if r["doc_id"] is not None)

    items = [tuple(r) for r in table(spark, sf, "benchmark").collect()]
    bad = brute_contamination([(i, r["text"]) for i, r in enumerate(rows["near_dedup"])], items)
    assert sorted(str(r) for i, r in enumerate(rows["near_dedup"]) if not bad[i][4]) == sorted(map(str, rows["decontamination"]))
    assert {r["doc_id"] for r in rows["packing"]} == {r["doc_id"] for r in rows["decontamination"] if r["text"] and r["text"].strip()}


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "n_tokens", "seq_id", "seq_offset"] and out.count() > 0


def test_empty_documents(spark, sf):
    docs = table(spark, sf, "documents").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_stages_with_clashing_columns_and_rows_under_one_id(spark, sf):
    from pyspark.sql import functions as F

    from costlens.llm.near_dup import drop_near_duplicates

    docs = table(spark, sf, "documents").limit(60)
    wide = docs
    for c in ("_bad", "_drop", "_again", "_id", "_digest", "id", "d", "b", "row", "set_hash", "component", "h", "lang_pred", "score"):
        wide = wide.withColumn(c, F.lit(c))
    for name, stage in corpus_pipeline.STAGES:
        plain, other = stage(spark, docs, sf), stage(spark, wide, sf)
        if name == "packing":
            assert sorted(map(str, plain.collect())) == sorted(map(str, other.collect()))
        else:
            assert other.columns == wide.columns
            assert sorted(map(str, plain.collect())) == sorted(map(str, other.select(*docs.columns).collect()))

    several = spark.createDataFrame([(1, t, "en", "s", 1) for t in ("one two three", "zwei drei", "zwei drei", None)] * 3, docs.schema)
    kept = [drop_near_duplicates(several.repartition(p)).collect() for p in (1, 5)]
    assert len(kept[0]) == 1 and kept[0] == kept[1] and kept[0][0]["text"] is not None
