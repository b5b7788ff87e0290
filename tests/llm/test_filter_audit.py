"""The filter audit against counting every order by hand."""

import collections
import re

from pyspark.sql import functions as F

from costlens.llm import filter_audit as A

LABEL = "doc_id long, quality int, toxic int"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    out |= {"A"} if len(words) < 200 else set()
    out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
    out |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
    return out | ({"D"} if re.search("[#$%&*|]", text) else set())


def brute(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, t, lang in docs:
        f = failed(t or "") | ({"E"} if i is not None and i > least[t or ""] else set())
        parts[lang or ""].append((f, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        shapley = collections.Counter(next(c for c in o if c in f) for o in A.ORDERS for f, _, _ in rows if f)
        for o in A.ORDERS:
            for step in range(1, 6):
                c, before = o[step - 1], set(o[:step - 1])
                here = [(g, x) for f, g, x in rows if c in f and not f & before]
                out.append((part, o, step, c, sum(not f & (before | {c}) for f, _, _ in rows), len(here),
                            sum(c in f and bool(f & before) for f, _, _ in rows), sum(f == {c} for f, _, _ in rows),
                            sum(g for g, _ in here), sum(x for _, x in here), shapley[c]))
    return sorted(out)


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    return sorted(tuple(r) for r in A.audit(d, spark.createDataFrame(labels, LABEL)).collect())


def test_all_kinds_of_rows(spark, prose):
    long = prose(250, 1)
    docs = [(1, long, "en"), (2, long, "en"), (3, long + " #", "de"), (4, long.upper(), None), (5, "a " * 300, ""), (6, None, "en"),
            (7, "", "en"), (None, long, "en"), (None, "x", None), (8, "x", "fr"), (8, "x", "fr"), (8, long, "fr"), (2, long, "en"),
            (9, "\x0bA\x0cb c\t", "fr"), (10, "é\U0001F600 B", "fr")]
    docs += [(100 + i, "hot", "en") for i in range(400)] + [(900 + i, prose(210, i + 5), "en") for i in range(60)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (8, None, 1), (100, 1, None), (150, 1, 1), (None, 1, 1), (6, 1, 0), (77, 1, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], []) == []
    docs = [(1, "a", "en"), (2, "a", "en")]
    assert run(spark, docs, []) == brute(docs, [])
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    for c in ("id", "part", "mask", "key", "n", "c", "piece", "bits", "first", "doubt", "good"):
        d = d.withColumn(c, F.lit(None).cast("string"))
    assert sorted(tuple(r) for r in A.audit(d, spark.createDataFrame([], LABEL)).collect()) == brute(docs, [])


def test_the_sketch_clears_unique_texts_only(spark, prose):
    rows = spark.createDataFrame([(i, prose(20, i % 900)) for i in range(1000)], "id long, text string").select(
        "id", F.unhex(F.sha2("text", 256)).alias("key"))
    bitmap = A.shared_counters(rows, 1 << 14)
    doubt = {r[0] for r in A.with_doubt(rows, bitmap, 1 << 14).where("doubt").collect()}
    repeats = {i for i in range(1000) if i < 100 or i >= 900}
    assert repeats <= doubt and len(doubt - repeats) < 80


def test_a_crowded_sketch_changes_no_result(spark, prose, monkeypatch):
    docs = [(i, prose(5, i % 200), "en") for i in range(260)]
    monkeypatch.setattr(A, "BITMAP_PIECES", 0)  # joined by shuffle
    assert run(spark, docs, []) == brute(docs, [])


def test_very_long_text(spark):
    docs = [(1, "word " * 1_000_000, "en"), (2, "word " * 1_000_000, "en")]
    assert run(spark, docs, []) == brute(docs, [])
