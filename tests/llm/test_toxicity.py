"""The string kernel against sums over all subsequences, and the fitted model on held-out documents."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm import queries as Q
from costlens.llm import toxicity as X


def rows_of(*words):
    got = list(X.windows(list(words)))
    return np.concatenate([r for _, r in got])


def naive(word):
    """Weight of each letter triple of ^word$ by going through all of them."""
    s, out = f"^{word}$", {}
    s = [("edge" if c in "^$" else c) for c in s]
    for i, j, k in itertools.combinations(range(len(s)), 3):
        if (j - i, k - j) in X.STEPS:
            t = (s[i], s[j], s[k])
            out[t] = out.get(t, 0) + X.DECAY ** (k - i - 2)
    return out


def kernel(a, b):
    x, y = naive(a), naive(b)
    return sum(w * y.get(t, 0) for t, w in x.items()) / np.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values()))


def test_kernel_equals_the_sum_over_subsequences():
    words = ["idiot", "idxiot", "worthless", "banana", "nananana", "cat", "tact", "aaaa"]
    got = X.similarities(rows_of(*words), rows_of(*words))
    assert np.allclose(got, [[kernel(a, b) for b in words] for a in words], atol=1e-5)


def test_margin_equals_the_kernel_expansion():
    words = ["idiot", "loser", "banana", "nanana", "theory"]
    marks, beta, bias = rows_of("idiot", "banana", "stone"), np.array([1.2, 0.9, -0.7]), -0.4
    code, weight = X.triples(marks)
    table = np.zeros(X._CLASSES ** 3)
    np.add.at(table, code, (beta / X._norms(code, weight))[:, None] * weight)
    table[0] = 0
    want = [sum(b * kernel(w, m) for b, m in zip(beta, ("idiot", "banana", "stone"))) + bias for w in words]
    got = X.margins(rows_of(*words), table.astype(np.float32), bias, floor=-0.3)
    assert np.allclose(got, np.maximum(want, -0.3), atol=1e-5)


def test_inserted_characters_and_spaces_are_skipped():
    plain = rows_of("idiot")
    for text in ("i.d.i.o.t", "i d i o t", "IDIOT!", "*id-iot*", "i_d_i_o_t"):
        assert (rows_of(text) == plain).all(), text
    assert kernel("idxiot", "idiot") > 0.45 > kernel("ideal", "idiot")


def test_windows_cover_long_words_and_texts(monkeypatch):
    word = "".join(random.Random(3).choice("abcdefgh") for _ in range(100))
    rows = rows_of(word)
    spelled = {"".join(chr(96 + c) for c in r if 0 < c < 27) for r in rows}
    assert all(any(word[i:i + 12] in s for s in spelled) for i in range(89))
    monkeypatch.setattr(X, "_PIECE", 200)
    text = " ".join(f"filler{chr(97 + i % 26)}" for i in range(300)) + " idiot " + "more " * 50
    assert (rows_of(text) == np.pad(rows_of("idiot")[0], (0, 0))).all(axis=1).any()


def test_svm_against_plain_descent():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = np.where(x @ [1, -2, 0.5] + 0.3 + rng.normal(0, 0.5, 200) > 0, 1.0, -1.0)
    w, b = X.fit_svm(x, y, np.ones(200))
    loss = lambda w, b: 0.5 * (w @ w + 1e-3 * b * b) + 0.5 * (np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()
    best = loss(w, b)
    for _ in range(200):
        assert best <= loss(w + rng.normal(0, 0.05, 3), b + rng.normal(0, 0.05)) + 1e-9


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, X.fit_toxicity_model(docs, labels, Q.fold("doc_id", 5) != 0)


def test_held_out_documents(learned):
    docs, labels, model = learned
    out = X.score_toxicity(docs, model).join(labels, F.col("id") == F.col("doc_id")).where(Q.fold("id", 5) == 0)
    rows = out.select("toxic", "predicted", "score").collect()
    toxic, clean = [r for r in rows if r[0] == 1], [r for r in rows if r[0] == 0]
    assert len(toxic) > 60 and sum(r[1] for r in toxic) >= 0.85 * len(toxic)  # some are marked at random
    assert sum(r[1] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r[2] <= 1 and r[1] == (r[2] >= 0.5) for r in rows)


def test_gapped_insults_in_clean_prose(learned, prose):
    _, _, model = learned
    text = "Of thndou thre thatble atre. {} Orouan is, orsh ha, heor thnd, on able {} of inin."
    clean, spaced, dotted = model.judge([text.format("was", "re"), text.format("l o s e r", "i d i o t"), text.format("st.up.id", "mo-ron")])
    assert clean < 0.5 < min(spaced, dotted)


def test_whole_texts_nulls_and_repeats(spark, learned):
    _, _, model = learned
    pad = "Thre thatble atre thananth at hesh. " * 60_000  # two million characters
    rows = [(1, None), (2, ""), (3, "..., 12 #"), (None, "Th re"), (5, pad + " stupid moron. " + pad), (6, pad), (5, "x"), (5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("a")).withColumn("score", F.lit(9))
    got = X.score_toxicity(df, model).collect()
    assert len(got) == len(rows) and len({r["score"] for r in got if r["id"] in (1, 2, 3)}) == 1
    by_text = dict(zip([r[1] for r in rows], model.features([r[1] for r in rows])))
    assert by_text[rows[4][1]][0] > 0 > by_text[pad][0]


def test_tables_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, "others there")], "doc_id long, text string")
    every = F.lit(True)
    for rows, want in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0), ([(None, 1), (2, None), (9, 1)], 0.0)):
        model = X.fit_toxicity_model(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), every)
        assert {round(r["score"], 3) for r in X.score_toxicity(docs, model).collect()} == {want}
    assert X.score_toxicity(docs.limit(0), X._constant(0.5)).count() == 0


def test_repeated_and_doubly_labelled_ids(spark):
    rows = [(i, f"plain words of text {chr(97 + i % 20)}uvw" + (" scumbag" if i % 4 == 0 else "")) for i in range(80)]
    docs = spark.createDataFrame(rows + [(4, rows[4][1])] * 50 + [(None, "scumbag")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)] + [(4, 0), (8, 1)], "doc_id long, toxic int")
    one = X.fit_toxicity_model(docs, labels, F.lit(True))
    other = X.fit_toxicity_model(docs.repartition(5), labels.repartition(2), F.lit(True))
    assert (one.table == other.table).all() and (one.curve == other.curve).all()
    scores = dict(X.score_toxicity(docs, one).select("id", "predicted").distinct().collect())
    assert all(scores[i] == int(i % 4 == 0) for i in range(80))


def test_training_rows_only(spark):
    """Labels outside the training condition teach nothing."""
    docs = spark.createDataFrame([(i, "plain words" + (" scumbag" if i % 2 else "")) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = X.fit_toxicity_model(docs, labels, (F.col("doc_id") % 2 == 0) | F.lit(None))
    assert not model.table.any()
