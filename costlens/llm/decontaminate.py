"""Benchmark decontamination by winnowing; DataFrame functions only.

Words are hashed in k-grams, and of every run of w successive k-grams the
smallest hash is kept as a fingerprint. Two texts that share
``k + w - 1`` words in a row share that run, so they share its fingerprint:
no shared window can be missed. Fingerprints of documents and benchmark items
are joined, and each hit is extended word by word to both sides with the
words themselves, so a hash collision never counts.

Windows are ``window`` words; an item of fewer words is one window, found the
same way with the k and w of its own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import ascii_lower, broadcast_small, let, stash

WINDOW = 10
# Fingerprints of items (a hash, some 15 words and an id each) that are broadcast at most; more are joined by shuffle.
BROADCAST_PRINTS = 100_000
# What lies between words; cutting at it takes a third of the time of matching the words.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# A fingerprint is a 34-bit hash above the position of its k-gram; positions fit any text that Spark can hold.
POSITION_BITS = 30
MASK = (1 << POSITION_BITS) - 1


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    parts = F.array_remove(F.split(ascii_lower(text), BETWEEN), "")  # nothing before the first and after the last word
    return F.coalesce(parts, F.array().cast("array<string>"))


def gram_length(span: int) -> int:
    """k for shared spans of ``span`` words; w is span - k + 1."""
    return (span + 1) // 2


def fingerprints(w: Column, span: int) -> Column:
    """Array of the fingerprints (hash above position, one long each) of a text's words, for spans of ``span`` words."""
    k = gram_length(span)
    run = span - k + 1

    def grams(h):
        first = F.sequence(F.lit(0), F.size(h) - k)
        return F.transform(first, lambda i: F.shiftleft(F.xxhash64(*[h[i + j] for j in range(k)]), POSITION_BITS) + i)

    def smallest(v):
        if run == 1:
            return v
        first = F.sequence(F.lit(0), F.size(v) - run)
        return F.array_distinct(F.transform(first, lambda i: F.least(*[v[i + j] for j in range(run)])))

    def all_of(v):
        return let(F.transform(v, lambda x: F.xxhash64(x)), lambda h: let(grams(h), smallest))

    return let(w, lambda v: F.when(F.size(v) >= span, all_of(v)).otherwise(F.array().cast("array<bigint>")))


def _split(code: Column) -> list[Column]:
    """The hash and the position of a fingerprint."""
    return [F.shiftright(code, POSITION_BITS).alias("hash"), code.bitwiseAND(F.lit(MASK)).cast("int").alias("at")]


def _near(w: Column, span: int, at: Column) -> Column:
    """The words from span - k before the k-gram at ``at`` to span - k after it; null beyond the ends of the text."""
    return F.array(*[F.get(w, at + j) for j in range(gram_length(span) - span, span)])


def _near_any(w: Column, spans: list[int], span: Column, at: Column) -> Column:
    """The words around a fingerprint of one of ``spans``."""
    out = F.array().cast("array<string>")
    for s in spans:
        out = F.when(span == s, _near(w, s, at)).otherwise(out)
    return out


def _reach(a: Column, b: Column, at: list[int]) -> Column:
    """How many of the positions ``at``, in turn, hold equal words in both contexts."""
    out = F.lit(len(at))
    for n in reversed(range(len(at))):
        out = F.when(F.coalesce(F.get(a, F.lit(at[n])) == F.get(b, F.lit(at[n])), F.lit(False)), out).otherwise(F.lit(n))
    return out


def item_fingerprints(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """Fingerprints (span, hash, near, item_id) of all items, and the spans that occur (``window`` of them at most)."""
    base = items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    base = base.where(F.size("w") > 0).withColumn("span", F.least(F.size("w"), F.lit(window)))
    spans = sorted(r[0] for r in base.select("span").distinct().collect())
    rows = None
    for s in spans or [window]:
        one = base.where(F.col("span") == s).select("item_id", "span", "w", F.explode(fingerprints(F.col("w"), s)).alias("code"))
        one = one.select("item_id", "span", "w", *_split(F.col("code")))
        one = one.select("span", "hash", _near(F.col("w"), s, F.col("at")).alias("near"), "item_id")
        rows = one if rows is None else rows.unionByName(one)
    return rows.distinct(), spans


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the matched runs as (start, end) word numbers, end
    included. Items found are the distinct item ids as strings; a null item
    id is not reported but its words count as hit. Null and empty texts have
    no words. Repeated document rows each get a row; no documents or no items
    give no rows and no hits. Other columns are left out. A row holds its
    words and a long for each fingerprint, however long the text; the words
    around a fingerprint are read one fingerprint at a time, and where the
    items' fingerprints are few enough to be broadcast, only of those that
    an item has too.
    """
    prints, spans = item_fingerprints(items, text_col="text", window=window)
    prints = stash(prints, "fingerprints")
    few = prints.limit(BROADCAST_PRINTS + 1).count() <= BROADCAST_PRINTS
    base = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       words(F.col(text_col)).alias("w"))
    # Beside its fingerprints every document sends one row that carries its length and meets no item: span 0.
    own = F.array(F.size("w").cast("bigint"))
    found = base.select("doc_id", "row", "w", F.posexplode(F.array(own, *[fingerprints(F.col("w"), s) for s in spans])).alias("n", "codes"))
    rows = found.select("doc_id", "row", "w", F.element_at(F.array(*[F.lit(s) for s in [0, *spans]]), F.col("n") + 1).alias("span"),
                        F.explode("codes").alias("code"))
    rows = rows.select("doc_id", "row", "w", "span", *_split(F.col("code")))
    near = _near_any(F.col("w"), spans, F.col("span"), F.col("at")).alias("a")
    if not few:  # these rows are shuffled, so they take their words along instead of the whole text
        rows = rows.select("doc_id", "row", "span", "hash", "at", near)
    i = prints.select(F.col("span").alias("i_span"), F.col("hash").alias("i_hash"), F.col("near").alias("b"), "item_id")
    met = rows.join(F.broadcast(i) if few else i, F.expr("span = i_span and hash = i_hash"), "left")
    met = met.where("span = 0 or i_hash is not null")
    met = met.select("doc_id", "row", "span", "at", near if few else "a", "b", "item_id")

    start, end = F.lit(None).cast("int"), F.lit(None).cast("int")
    for s in spans:
        k = gram_length(s)
        side = s - k
        a, b = F.col("a"), F.col("b")
        gram = _reach(a, b, list(range(side, side + k)))
        left, right = _reach(a, b, list(range(side - 1, -1, -1))), _reach(a, b, list(range(side + k, s + side)))
        whole = (F.col("span") == s) & (gram == k) & (left + right + k >= s)
        start = F.when(whole, F.col("at") - left).otherwise(start)
        end = F.when(whole, F.col("at") + k - 1 + right).otherwise(end)
    hit = met.select("doc_id", "row", "span", "at", "item_id", start.alias("s"), end.alias("e"))
    per = hit.groupBy("row", "doc_id").agg(
        F.max(F.when(F.col("span") == 0, F.col("at"))).alias("n_words"),
        F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("spans"),
        F.collect_set(F.when(F.col("s").isNotNull(), F.col("item_id"))).alias("items"))
    at = F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["s"], x["e"]))))
    return per.select(
        "doc_id", F.col("n_words").cast("long"), F.size(at).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all their columns, that share no window with an item.

    A verdict hangs on the text alone, so rows are dropped by the digest of
    their text: ids may be null or repeated, ``id_col`` is not read. Null and
    empty texts have no words and stay. Other columns may have any names.
    """
    texts = docs.select(F.sha1(F.col(text_col)).alias("doc_id"), F.col(text_col).alias("text"))
    bad = contamination(texts, items, window=window).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    bad = broadcast_small(stash(bad, "contaminated"))
    return docs.alias("d").join(bad.alias("b"), F.sha1(F.col(f"d.{text_col}")) == F.col("b._bad"), "left_anti")
