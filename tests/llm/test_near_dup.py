import random

import numpy as np

from costlens.llm.components import connected_components
from costlens.llm.near_dup import _linked, band_keys, drop_near_duplicates, near_duplicates, signature
from costlens.llm.shingles import CHUNK, shingle_set, word_hashes


def shingles(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if x]
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def brute(docs, percent):
    sets = [shingles(t) for _, t in docs]
    comp = list(range(len(docs)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(docs[i][0])
    low = {d: min(g) for g in groups.values() for d in g}
    return {d: (len(sets[i]), low[d], low[d] == d) for i, (d, _) in enumerate(docs)}


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"q{rng.random()}"
    return " ".join(w)


def corpus(prose):
    base = prose(150, 1)
    docs = [(100 + i, edited(base, i % 7, i)) for i in range(60)]
    docs += [(i, prose(40, 50 + i)) for i in range(20)] + [(40 + i, prose(40, 50)) for i in range(8)]
    docs += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "é É"), (207, "É é")]
    docs += [(300 + i, edited(prose(4000, 9), i, i)) for i in range(3)]
    return docs


def test_like_brute_force(spark, prose):
    docs = corpus(prose)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS rep", "3 AS component_id")
    for percent in (85, 80):
        got = {r[0]: tuple(r)[1:] for r in near_duplicates(df.repartition(5), percent=percent).collect()}
        assert got == brute(docs, percent)


def test_blocks_of_a_hot_group(spark, prose, monkeypatch):
    from costlens.llm import near_dup
    monkeypatch.setattr(near_dup, "BLOCK", 4000)
    docs = corpus(prose)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute(docs, 85)


def test_repeats_nulls_and_empty(spark, prose):
    a, b = prose(30, 1), prose(30, 2)
    df = spark.createDataFrame([(5, a), (5, a), (5, b), (9, b), (7, a), (None, a), (8, None)], "doc_id long, text string")
    got = sorted((r[0] or 0, r[2] or 0, r[3]) for r in near_duplicates(df).collect())
    assert got == [(0, 0, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True), (9, 5, False)]
    left = drop_near_duplicates(df).collect()
    assert sorted(r[0] or 0 for r in left) == [0, 5, 8]
    empty = df.where("doc_id > 1000")
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_shingles_like_words(prose):
    for t in ("", " a", "a b c d e f a b c d e", prose(500), "x " * 50, "Ä b\tC\nd\x0be\x0cf\rg"):
        assert len(shingle_set(t)) == len(shingles(t))
    long = "w" * (CHUNK + 10) + " " + "ab " * CHUNK
    assert len(word_hashes(long)) == CHUNK + 1 and len(set(word_hashes(long))) == 2


def test_signature_estimates_similarity(prose):
    a, b = shingle_set(prose(2000, 1)), shingle_set(edited(prose(2000, 1), 60, 2))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (signature(a, 2400) == signature(b, 2400)).mean()
    assert abs(same - true) < 0.06
    assert len(set(band_keys(signature(a)))) == 40
    assert list(_linked([a, a[:10], a], 85)) == [0, 1, 0]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        low[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges for x in e}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_hot_repeated_id_is_checked_once(spark, prose, monkeypatch):
    from costlens.llm import near_dup

    def few(sets, percent):
        assert len(sets) <= 2, len(sets)
        return _linked(sets, percent)

    monkeypatch.setattr(near_dup, "_linked", few)
    base = prose(150, 1)
    docs = [(5, base)] * 300 + [(9, edited(base, 2, 1)), (11, prose(60, 2))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == 302 and {r[0]: r[2] for r in got} == {5: 5, 9: 5, 11: 11}


def test_a_hot_id_of_many_texts_is_cut_into_blocks(spark, prose, monkeypatch):
    from costlens.llm import near_dup

    def few(sets, percent):
        assert len(sets) < 40, len(sets)
        return _linked(sets, percent)

    monkeypatch.setattr(near_dup, "_linked", few)
    monkeypatch.setattr(near_dup, "BLOCK", 4000)
    base = prose(150, 1)
    docs = [(5, edited(base, 2, i)) for i in range(80)] + [(9, base), (11, prose(60, 2))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r[0]: r[2] for r in got} == {5: 5, 9: 5, 11: 11}


def test_planted_pairs_in_the_given_vectors_are_found(spark):
    """Pairs at a cosine of 0.9801, added to the real table: recall over the planted ones."""
    import numpy as np

    from costlens.llm.embedding_dup import near_embeddings

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rng = np.random.default_rng(4)
    extra = []
    for r in rows[:400]:
        x = np.array(r["embedding"], dtype=np.float64)
        x /= np.linalg.norm(x)
        noise = rng.normal(size=len(x))
        noise -= (noise @ x) * x
        extra.append((10_000_000 + r["vec_id"], (0.9801 * x + np.sqrt(1 - 0.9801 ** 2) * noise / np.linalg.norm(noise)).tolist(), r["label"]))
    df = spark.createDataFrame([(r["vec_id"], [float(v) for v in r["embedding"]], r["label"]) for r in rows] + extra,
                               "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: r["component_id"] for r in near_embeddings(df, threshold=0.98).collect()}
    found = sum(got[i] == got[i - 10_000_000] for i, _, label in extra if label is not None)
    assert found >= 0.98 * sum(label is not None for _, _, label in extra)


def test_tables_narrow_until_the_recall_is_reached(recwarn):
    import numpy as np

    from costlens.llm import embedding_dup as E

    x = np.random.default_rng(2).normal(size=(600, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert E.fit_tables(x, 0.98)[2] == E.PART and not recwarn.list
    assert E.fit_tables(x, 0.9)[2] < E.PART
    E.fit_tables(x, -0.9)
    assert any("recall" in str(w.message) for w in recwarn.list)
