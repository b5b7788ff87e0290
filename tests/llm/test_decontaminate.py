import hashlib
import re

from costlens.llm import decontaminate
from costlens.llm.decontaminate import contamination, drop_contaminated, gram_length

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for i, itext in items:
            v = words(itext)
            n = min(10, len(v))
            windows = {tuple(v[a:a + n]) for a in range(len(v) - n + 1)} if n else set()
            for a in range(len(w) - n + 1 if n else 0):
                if tuple(w[a:a + n]) in windows:
                    hit |= set(range(a, a + n))
                    found.add(str(i))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS span", "2 AS hash", "'x' AS w")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id")
    rows = contamination(d, i).collect()
    return {r["doc_id"]: tuple(r)[1:6] for r in rows}, rows


def test_like_brute_force(spark, prose):
    item = prose(30, 1)
    w = item.split()
    items = [(1, item), (2, prose(10, 2)), (3, "One two, three!"), (4, None), (5, ""), (6, "Ünique"), (7, prose(12, 2)), (8, "a a a a a a a a a a a a")]
    docs = [(1, prose(40, 7)), (2, prose(5, 8) + " " + " ".join(w[3:13]) + ". " + prose(9, 9)), (3, " ".join(w[3:12])),
            (4, item.upper()), (5, "x ONE-two three y"), (6, None), (7, ""), (8, "a " * 25), (9, "ünique Ünique"),
            (10, prose(10, 2)), (11, " ".join(w[:15]) + " zz " + " ".join(w[15:])), (12, "!!! ..."), (13, "one two"),
            (14, prose(3000, 5) + " " + prose(12, 2) + " " + prose(3000, 6)), (-5, "one two three")]
    got, _ = run(spark, docs, items)
    assert got == brute(docs, items)


def test_every_span_length_is_found(spark, prose):
    for n in range(1, 13):
        item = prose(n, n)
        got, rows = run(spark, [(1, "before " + item + " after"), (2, "nothing here")], [(n, item)])
        assert got[1][1] == n and not got[2][4], n
        assert 1 <= gram_length(n) <= n


def test_empty_tables_repeats_and_nulls(spark, prose):
    got, _ = run(spark, [(1, "some words")], [])
    assert got == {1: (2, 0, 0, hashlib.sha256(b"").hexdigest(), False)}
    assert run(spark, [], [(1, prose(20))])[1] == []
    item = prose(12, 3)
    _, rows = run(spark, [(1, item), (1, item), (None, item), (1, "clean")], [(None, item)])
    assert sorted((r["doc_id"] or 0, r["n_hit"], r["n_items"]) for r in rows) == [(0, 12, 0), (1, 0, 0), (1, 12, 0), (1, 12, 0)]


def test_drop_keeps_clean_rows_and_columns(spark, prose):
    item = prose(15, 4)
    docs = spark.createDataFrame([(1, item, "a"), (2, "fine", None), (2, "fine", "b"), (None, "fine", "c")], "doc_id long, text string, source string")
    out = drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == ["(2, 'fine', 'b')", "(2, 'fine', None)", "(None, 'fine', 'c')"]


def test_drop_is_by_row_not_by_id(spark, prose):
    item = prose(15, 4)
    rows = [(None, "fine"), (None, item), (None, "fine too"), (None, None), (1, "before " + item), (1, "fine"), (1, "fine"), (2, item), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(r) for r in rows if item not in (r[1] or ""))


def test_fingerprints_joined_by_shuffle(spark, prose, monkeypatch):
    """Items with more fingerprints than are broadcast give the same rows."""
    item = prose(30, 1)
    items = [(1, item), (2, "One two, three!"), (3, prose(12, 2)), (4, None), (5, "one")]
    docs = [(1, "so " + item), (2, "x ONE-two three y"), (3, None), (4, prose(40, 7)), (5, prose(3000, 5) + " " + prose(12, 2)), (6, "one")]
    got, _ = run(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_PRINTS", 0)
    assert run(spark, docs, items)[0] == got == brute(docs, items)


def test_word_cuts(spark, prose):
    """Separators at either end, other scripts, NUL, controls and white space beyond ASCII."""
    odd = ["...", " a ", "\x00a\x00b\x00", "a b", "ÀB c", "1 2-3", "`x{y}", "中文 字", "😀 x😀", "\x7f", "İI", " ", "_a_", "@z["]
    docs = [(n, t) for n, t in enumerate(odd)]
    assert run(spark, docs, [(1, "a b"), (2, "x"), (3, "😀")])[0] == brute(docs, [(1, "a b"), (2, "x"), (3, "😀")])


def test_very_long_text(spark, prose):
    item = prose(40, 3)
    n = 1_000_000
    text = "the same few words again and again " * (n // 7) + item
    got, _ = run(spark, [(1, text), (2, item)], [(7, item)])
    assert got[1][:3] == (n // 7 * 7 + 40, 40, 1) and got[2][:3] == (40, 40, 1)
