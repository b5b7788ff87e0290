"""Packing, sharding, WARC, URL filter and embeddings against brute force or exact round trips."""

import hashlib
import io
import random
import struct
from collections import Counter

import numpy as np
import pytest

from costlens.llm import sharding, url_filter, warc
from costlens.llm.embedding_dup import near_embeddings
from costlens.llm.packing import best_fit, pack


def naive_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [(capacity - used, i) for i, (used, ss, cc) in enumerate(bins)
                if capacity - used >= n and not (s is not None and s in ss) and not (c is not None and c in cc)]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([0, set(), set()])
        out.append((i, bins[i][0]))
        bins[i][0] += n
        bins[i][1].add(s)
        bins[i][2].add(c)
    return out


def test_best_fit_like_brute_force():
    rng = random.Random(2)
    for _ in range(20):
        n = rng.randrange(1, 120)
        x = sorted((rng.randrange(1, 101) for _ in range(n)), reverse=True)
        s = [rng.choice([None, "a", "a", "b", "c", "d"]) for _ in x]
        c = [rng.choice([None, None, 1, 2, 3]) for _ in x]
        assert best_fit(x, s, c, 100) == naive_fit(x, s, c, 100)


def test_pack(spark, prose):
    rng = random.Random(3)
    rows = [(i, prose(rng.choice([3, 40, 90, 250]), i % 50), rng.choice(["hot", "hot", "a", "b", None])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "a"), (902, prose(100, 1), "x"), (902, prose(100, 1), "x"), (None, "five words are in here", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS piece", "2 AS grp", "3 AS n")
    out = pack(df, capacity=100, per_group=64).collect()
    bins, per_doc, source, text = {}, Counter(), {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}
    for r in out:
        bins.setdefault(r["seq_id"], []).append(r)
        per_doc[r["doc_id"]] += r["n_tokens"]
    for pieces in bins.values():
        pieces.sort(key=lambda r: r["seq_offset"])
        at = 0
        for p in pieces:
            assert p["seq_offset"] == at
            at += p["n_tokens"]
        assert at <= 100
        named = [source[p["doc_id"]] for p in pieces if source[p["doc_id"]] is not None]
        assert len(named) == len(set(named))
        texts = [text[p["doc_id"]] for p in pieces]
        assert len(texts) == len(set(texts))
    assert per_doc[902] == 200 and per_doc[None] == 5 and 900 not in per_doc and 901 not in per_doc
    assert all(per_doc[r[0]] == len(r[1].split()) for r in rows[:300])
    assert pack(df.where("doc_id > 5000")).count() == 0


def test_slot_table_like_brute_force():
    shards, size = [f"s{i}" for i in range(7)], 211
    order = sorted(range(7), key=lambda i: shards[i])
    prefs = {i: [(o + j * k) % size for j in range(size)] for i in order for o, k in [sharding.preference(shards[i], size)]}
    table, left = [-1] * size, size
    while left:
        for i in order:
            if left:
                table[next(s for s in prefs[i] if table[s] < 0)] = i
                left -= 1
    assert sharding.fill_table(shards, size) == table
    share = Counter(table).values()
    assert max(share) - min(share) <= 1
    fewer = sharding.fill_table(shards[:6], size)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < size * 0.25
    assert sharding.fill_table(shards[::-1], size) == [6 - i for i in table]
    with pytest.raises(ValueError):
        sharding.fill_table(shards, 210)
    with pytest.raises(ValueError):
        sharding.fill_table([], 211)


def test_assign_shards(spark):
    rows = [(i, "x", 9) for i in range(500)] + [(3, "y", 1)] + [(None, str(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, shard int")
    names = [f"s{i}" for i in range(5)]
    out = sharding.assign_shards(df, ["doc_id"], names, 1009, spread=["source"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
    got = out.collect()
    table = sharding.fill_table(names, 1009)
    assert len(got) == len(rows) and all(table[r["slot"]] == r["shard"] and names[r["shard"]] == r["shard_name"] for r in got)
    assert len({r["shard"] for r in got if r["doc_id"] == 3}) == 1
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 5
    assert sharding.assign_shards(df.where("doc_id < 0"), ["doc_id"], names).count() == 0


def test_warc_round_trip(spark, tmp_dir):
    big = "<p>é</p>" * 400
    rows = [(1, "http://a/b c%20\r\nX: y", big), (2, "http://b", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "é", None),
            (7, "u", ""), (None, "n", big), (9, "u", "\r\n\r\nx" * 300), (9, "u", "\r\n\r\nx" * 300), (3, "again", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS n", "3 AS payload")
    manifest = warc.write_warc(warc.with_roles(df))
    back = warc.read_warc(manifest).collect()
    assert len(back) == len(rows)
    sha = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    want = []
    for i, u, h in rows:
        revisit = h == big and i != 3
        want.append((i, u, len((h or "").encode()), sha(h), "revisit" if revisit else "response", 3 if revisit else None))
    got = [(r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert sorted(map(str, got)) == sorted(map(str, want))
    texts = {(r["page_id"], r["payload"].decode()) for r in back if r["record_type"] == "response"}
    assert (3, big) in texts and (9, "\r\n\r\nx" * 300) in texts
    assert sum(r["records"] for r in manifest.collect()) == len(rows)
    assert warc.read_warc(warc.write_warc(warc.with_roles(df.where("page_id > 99")))).count() == 0


def test_archive_has_dictionary_and_single_frames(spark):
    import zstandard
    rows = [(i, "u", f"<html><body><p>page {i} of the same site</p></body></html>" * 5) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    m = warc.write_warc(warc.with_roles(df)).collect()[0]
    system, _ = warc.filesystem(m["folder"])
    data = system.open_input_stream(m["path"]).read()
    magic, n = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and zstandard.ZstdCompressionDict(data[8:8 + n]).dict_id()
    assert len(list(warc.read_frames(io.BytesIO(data)))) == 300
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(data[:-3])))


def test_url_filter(spark):
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("a.b.org/", "block")]
    urls = ["http://x.example.net/en/1", "https://EXAMPLE.net/de/", "http://example.com/de/x?y", "http://www.example.com/de", "http://net",
            "http://net/", "http://a.b.org/fr/", "http://ab.org/fr/1", "http://notexample.com/de/", None, "", "no scheme", "ftp://q.org/fr/#z",
            "http://h.net?x=/", "a://b://c/", "http:///net/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS key")
    model = url_filter.fit_url_filter(df, spark.createDataFrame(rules, "rule string, action string"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, model).collect()}

    def want(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end].lower(), rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fit = [(r, a) for r, a in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
        return host, path, *rule

    assert got == {i: want(u) for i, u in enumerate(urls)}
    none = url_filter.fit_url_filter(df.where("page_id < 0"), spark.createDataFrame([], "rule string, action string"))
    assert {r["verdict"] for r in url_filter.judge_urls(df, none).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.range(400).selectExpr("concat('k', id) AS key")
    universe = spark.range(30000).selectExpr("concat('k', id % 20000) AS key")
    c = url_filter.build_cascade(listed, universe, 400)  # a low bound gives a poor first level and many levels
    keys = [f"k{i}" for i in range(20000)]
    assert len(c.levels) > 3
    assert (c.contains(keys) == np.array([i < 400 for i in range(20000)])).all()


def brute_links(rows, threshold):
    n, comp = len(rows), list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and label is not None for _, v, label in rows]
    count = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    count[i] += 1
                    x, y = find(i), find(j)
                    comp[max(x, y)] = min(x, y)
    return {rows[i][0]: (count[i], rows[find(i)][0], find(i) == i) for i in range(n)}


def test_embeddings_like_brute_force(spark):
    rng = np.random.default_rng(1)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    base = rng.normal(size=(30, 32))
    rows = [(i, f32(base[i % 30] + rng.normal(size=32) * (0.08 if i >= 30 else 0)), i % 30 % 3) for i in range(150)]
    rows += [(200 + i, f32(base[0]), 0) for i in range(20)] + [(300, f32(base[0] * 2), 0), (301, f32(base[0]), None), (302, None, 0), (303, [], 0),
             (304, [0.0] * 32, 0), (305, [float("nan")] * 32, 0), (306, [None] * 32, 0), (307, [float("inf")] * 32, 0), (308, f32(base[0])[:16], 0), (309, f32(base[0])[:16], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS key", "2 AS code", "3 AS tab")
    got = {r[0]: tuple(r)[1:] for r in near_embeddings(df, sample=64).collect()}
    want = brute_links(rows, 0.98)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert {i: g for i, g in got.items() if i >= 200} == {i: w for i, w in want.items() if i >= 200}
    assert near_embeddings(df.where("vec_id < 0")).count() == 0


def test_embeddings_hot_bucket_in_blocks(spark, monkeypatch):
    from costlens.llm import embedding_dup
    monkeypatch.setattr(embedding_dup, "STORED", 16)
    monkeypatch.setattr(embedding_dup, "ASKING", 32)
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in base + rng.normal(size=16) * 0.1], 1) for i in range(120)] + [(500, None, None), (500, None, None)]
    got = {r[0]: tuple(r)[1:] for r in near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    want = brute_links(rows[:-1], 0.98)
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(w[0] for w in want.values())
    assert got[500] == (0, 500, True)


def test_packing_does_not_hang_on_the_layout(spark, sf):
    from costlens.llm.common import table
    from costlens.llm.packing import pack

    docs = table(spark, sf, "documents")
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.limit(20)).unionByName(docs.limit(5).selectExpr(
        "cast(null AS long) AS doc_id", "text", "lang", "source", "n_chars"))
    got = [sorted(map(tuple, pack(docs.repartition(p), per_group=64).collect()), key=str) for p in (1, 7)]
    assert got[0] == got[1] and len(got[0]) > docs.count() * 0.9


def test_level_of_several_slices_sets_the_bits_of_its_keys(spark, monkeypatch):
    import numpy as np

    from costlens.llm import url_filter as U

    monkeypatch.setattr(U, "SLICE_WORDS", 4)
    keys = [f"k{i}" for i in range(200)]
    level = U.build_level(spark.createDataFrame([(k,) for k in keys], "key string").repartition(3), 200, 0.01, 5)
    want = np.zeros(len(level.words), dtype=np.uint64)
    for p in np.unique(level.positions(keys)):
        want[int(p) >> 6] |= np.uint64(1 << (int(p) & 63))
    assert len(level.words) > 8 and (level.words == want).all() and level.passes(keys).all()
