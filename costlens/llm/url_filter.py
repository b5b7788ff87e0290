"""URL filter with a Bloom filter cascade: exact rule membership without joins.

Every URL gives candidate keys (host suffix + path prefix, cut where a rule
could end). Level 1 of the cascade encodes the listed rules, level 2 those
corpus keys that pass level 1 by mistake, level 3 the rules that pass level
2, and so on until a level has no mistakes over the corpus's complete set of
keys. A key's first missed level then tells exactly whether it is listed. A
second cascade over the listed rules tells allow from block. Verdicts are a
scan with the two cascades; their size follows the rule list (times the
logarithm of the corpus), never the number of pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import UPPER, stash

# Largest total size of a cascade that is sent to the tasks (bits of one level).
MAX_LEVEL_BITS = 1 << 31
# Words of 64 bits that a row of a built level holds (32 KB).
SLICE_WORDS = 4096


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


@dataclass
class Level:
    """One Bloom filter; ``salt`` keeps the levels independent."""

    bits: int
    hashes: int
    salt: int
    words: np.ndarray = field(repr=False, default=None)

    def positions(self, keys) -> np.ndarray:
        """Bit positions, one row for each key."""
        d = np.array([xxhash.xxh3_128_intdigest(k, self.salt) for k in keys], dtype=object)
        a = np.array([x & 0xFFFFFFFFFFFFFFFF for x in d], dtype=np.uint64)
        b = np.array([x >> 64 | 1 for x in d], dtype=np.uint64)
        i = np.arange(self.hashes, dtype=np.uint64)
        return (a[:, None] + i * b[:, None]) % np.uint64(self.bits)

    def passes(self, keys) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        p = self.positions(keys)
        return ((self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)


@dataclass
class Cascade:
    levels: list[Level]

    def contains(self, keys) -> np.ndarray:
        """Exact for listed keys and for every key of the universe it was built over."""
        keys = np.asarray(keys, dtype=object)
        member, open_ = np.zeros(len(keys), dtype=bool), np.arange(len(keys))
        for n, level in enumerate(self.levels):
            hit = level.passes(keys[open_])
            member[open_[~hit]] = n % 2 == 1  # missed a level of mistakes: listed
            open_ = open_[hit]
        member[open_] = len(self.levels) % 2 == 1
        return member


def build_level(keys: DataFrame, n: int, p: float, salt: int) -> Level:
    """Bloom filter of the n keys in column ``key`` with false-positive rate p.

    Bits are set and put together in the tasks; the driver gets them in slices
    of 32 KB, as many bytes as the level has.
    """
    bits = max(64, math.ceil(n * math.log(1 / p) / math.log(2) ** 2))
    if bits > MAX_LEVEL_BITS:
        raise ValueError(f"a level of {bits} bits is over the bound that is sent to tasks; split the rule list")
    level = Level(bits, max(1, round(math.log2(1 / p))), salt)

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            pos = np.unique(level.positions(f["key"].tolist()))
            word = (pos >> np.uint64(6)).astype(np.int64)
            at, first = np.unique(word, return_index=True)
            bit = np.left_shift(np.uint64(1), pos & np.uint64(63))
            yield pd.DataFrame({"word": at, "value": np.bitwise_or.reduceat(bit, first).view(np.int64)})

    def joined(f: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(SLICE_WORDS, dtype=np.int64)
        out[f["word"].to_numpy() % SLICE_WORDS] = f["value"].to_numpy()
        return pd.DataFrame({"slice": [int(f["word"].iloc[0]) // SLICE_WORDS], "words": [out.tobytes()]})

    each = keys.select("key").mapInPandas(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value"))
    rows = each.withColumn("slice", F.floor(F.col("word") / SLICE_WORDS)).groupBy("slice").applyInPandas(
        lambda f: joined(f), "slice long, words binary").collect()  # at most bits / 64 / SLICE_WORDS rows
    held = np.zeros((bits // 64 // SLICE_WORDS + 1) * SLICE_WORDS, dtype=np.uint64)
    for r in rows:
        held[r["slice"] * SLICE_WORDS:(r["slice"] + 1) * SLICE_WORDS] = np.frombuffer(r["words"], dtype=np.uint64)
    level.words = held[:bits // 64 + 1]
    return level


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            k = f["key"].drop_duplicates()
            yield pd.DataFrame({"key": k[level.passes(k.tolist())]})

    return keys.select("key").mapInPandas(keep, "key string")


def build_cascade(listed: DataFrame, universe: DataFrame, universe_size: int) -> Cascade:
    """Cascade of the keys in ``listed`` (column key), exact over ``universe`` (column key, repeats allowed).

    ``universe_size`` is an upper bound of its distinct keys. The universe
    is scanned once; only keys that pass level 1 are kept. An empty list
    gives a cascade that contains nothing.
    """
    inside = listed.select("key").where(F.col("key").isNotNull()).distinct()
    n = inside.count()
    if not n:
        return Cascade([])
    levels = [build_level(inside, n, min(0.5, n / (math.sqrt(2) * max(universe_size, 1))), 1)]
    outside = stash(_passing(universe, levels[0]).distinct().join(inside, "key", "left_anti"), "cascade")
    # The two sides take turns; each level halves the other side's mistakes.
    side, other = outside, inside
    while (n := side.count()):
        levels.append(build_level(side, n, 0.5, len(levels) + 1))
        side, other = stash(_passing(other, levels[-1]), "cascade"), side
    return Cascade(levels)


@dataclass
class UrlFilter:
    """``listed``: all rules; ``allowed``: those that allow; cuts at which rules can end."""

    listed: Cascade
    allowed: Cascade
    label_counts: tuple[int, ...]
    path_lengths: tuple[int, ...]
    default: str = "allow"

    def candidates(self, host: str, path: str) -> list[str]:
        """Keys that could be rules for this URL, longest first, the longer host first among equals."""
        return _candidates(host, path, self.label_counts, self.path_lengths)


def _candidates(host, path, label_counts, path_lengths) -> list[str]:
    labels = host.split(".")
    hosts = [".".join(labels[-c:]) for c in label_counts if c <= len(labels)]
    keys = {(h, path[:n]) for h in hosts for n in path_lengths if n <= len(path)}
    return [h + p for h, p in sorted(keys, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0]), x))]


def _cut(rules: DataFrame) -> DataFrame:
    """A rule is a host and a path that begins at its first slash."""
    host = F.regexp_extract("rule", "^[^/]*", 0)
    return rules.select("rule", "action", host.alias("h")).withColumn(
        "c", F.size(F.split("h", "\\."))).withColumn("n", F.length("rule") - F.length("h"))


def fit_url_filter(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> UrlFilter:
    """Build the cascades of ``rules`` (rule, action = allow or block) over every key of ``pages``.

    A rule listed with both actions allows. Null rules are ignored.
    """
    rules = stash(rules.select("rule", "action").where(F.col("rule").isNotNull()).distinct(), "rules")
    cuts = _cut(rules)
    # Distinct cut positions: at most the labels of a host name and the characters of a rule.
    counts = tuple(r[0] for r in cuts.select("c").distinct().orderBy("c").collect())
    lengths = tuple(r[0] for r in cuts.select("n").distinct().orderBy("n").collect())

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.drop_duplicates()
            seen = {k for h, p in zip(f["host"], f["path"]) for k in _candidates(h, p, counts, lengths)}
            yield pd.DataFrame({"key": list(seen)}, dtype=object)

    url = F.col(url_col)
    universe = pages.select(url_host(url).alias("host"), url_path(url).alias("path")).mapInPandas(keys, "key string")
    bound = pages.count() * max(1, len(counts) * len(lengths))
    listed = build_cascade(rules.select(F.col("rule").alias("key")), universe, bound)
    allow = rules.where("action = 'allow'").select(F.col("rule").alias("key"))
    allowed = build_cascade(allow, rules.select(F.col("rule").alias("key")), rules.count())
    return UrlFilter(listed, allowed, counts, lengths, default)


def judge_urls(pages: DataFrame, model: UrlFilter, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule (the longest that fits, else null), verdict.

    A null URL or one without ``://`` has an empty host and path and gets
    the default verdict. Repeated rows are judged alike; other columns are
    left out. No shuffle.
    """
    spark = pages.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by MAX_LEVEL_BITS per level

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for f in frames:
            found = [m.candidates(h, p) for h, p in zip(f["host"], f["path"])]
            keys = sorted({k for x in found for k in x})
            known = {k for k, ok in zip(keys, m.listed.contains(keys)) if ok} if keys else set()
            rule = [next((k for k in x if k in known), None) for x in found]
            hits = sorted(known)
            allow = {k for k, ok in zip(hits, m.allowed.contains(hits)) if ok} if hits else set()
            f["rule"] = pd.Series(rule, dtype=object, index=f.index)
            f["verdict"] = [m.default if r is None else "allow" if r in allow else "block" for r in rule]
            yield f

    url = F.col(url_col)
    cols = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    kind = cols.schema["page_id"].dataType.simpleString()
    return cols.mapInPandas(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
