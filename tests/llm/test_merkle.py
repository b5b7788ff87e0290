"""The manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from costlens.llm import merkle

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(part(v) for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        n = out[-1]
        out.append([h("".join(n[j:j + 8])) for j in range(0, len(n), 8)])
    return out


def path(lv, i):
    out = []
    for nodes in lv[:-1]:
        at = i // 8 * 8
        run = nodes[at:at + 8]
        out.append(("".join(run[:i - at]), "".join(run[i - at + 1:])))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        leaves = sorted((((r[0] is not None, r[0] or 0), leaf_of(*r), r) for r in groups[g]), key=lambda x: x[:2])
        trees.append((leaves, levels([x[1] for x in leaves])))
    top = levels([lv[-1][0] for _, lv in trees])
    out = []
    for at, (leaves, lv) in enumerate(trees):
        for i, (_, leaf, r) in enumerate(leaves):
            p = path(lv, i) + path(top, at)
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = leaf_of(r[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for left, right in p:
                node = h(left + node + right)
            out.append((r[0], leaf, lv[-1][0], top[-1][0], h("".join(a + b for a, b in p)), node, node == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, schema=DOC, parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return sorted((tuple(r) for r in merkle.manifest(df, touched).collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 511, 512, 513, 1200])
def test_sizes_of_a_group(spark, n):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_three_rounds_of_blocks(spark, monkeypatch):
    """Small blocks, so that a few hundred leaves climb through several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, "aB", "en" if i % 9 else None, "s", None) for i in range(700)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_languages(spark):
    rng = random.Random(1)
    langs = [None, "", "de", "en", "ü", "z", "日本", "en ", "EN", "=x"]
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "", "Ab", "ÄÖ x", "q" * 5000]), rng.choice(langs),
             rng.choice([None, "", "a:b", "-"]), rng.choice([None, 0, -3])) for _ in range(300)]
    rows += [(7, "Same", "en", "s", 4)] * 900  # one row repeated: most of a group
    got = run(spark, rows)
    assert got == brute(rows) and any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_same_on_any_layout(spark):
    rows = [(i % 40, f"T{i % 55}", None, "s", i % 3) for i in range(600)]
    assert run(spark, rows, parts=1) == run(spark, rows, parts=7)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(i, "X", "en", "s", 1) for i in range(20)]
    df = spark.createDataFrame(rows, DOC)
    for c in ("g", "at", "n", "node", "item", "path", "root", "block", "level0", "id", "other", "_part"):
        df = df.withColumn(c, F.lit("?"))
    assert sorted((tuple(r) for r in merkle.manifest(df, F.crc32(F.col("doc_id").cast("string")) % 3 == 0).collect()),
                  key=str) == brute(rows)


def test_very_long_text(spark):
    rows = [(1, "Long " * 400_000, "en", "s", None), (2, None, "en", None, None)]
    assert run(spark, rows) == brute(rows)
