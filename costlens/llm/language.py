"""Language identification by nearest centroid over hashed character n-grams.

A text becomes the counts of its character 1- to 3-grams (letters, lower
case; anything else is a word boundary), hashed into ``DIM`` dimensions,
damped by the logarithm, weighted by inverse document frequency and scaled to
length 1. Every language has several centroids, found by spherical k-means
over a bounded sample of labelled texts. A text gets the language of the
centroid with the largest cosine, and is rejected when it lies much farther
from that language than nearly all of the language's sample texts did.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costlens.llm.common import broadcast_small, filter_by_text, stash

DIM = 8192
CENTROIDS = 4
# Labelled texts of a language that the model is fitted on, at most.
SAMPLE = 600
# A centroid holds this share of its language's sample at least, or is given up.
LEAST_SHARE = 0.05
# A language's radius is this share of the cosine that all but the share TAIL of its sample reach.
SLACK, TAIL = 0.5, 0.01
SHARPNESS = 25.0
NO_LANGUAGE = "und"
JUDGED = ["lang_pred", "score", "cosine", "rejected"]
# Characters hashed at once and texts judged at once: a task's arrays stay under about 30 MB, whatever the text.
_CHUNK, _TEXTS = 1 << 17, 256
_ALPHA: list[np.ndarray] = []


def _letters(code: np.ndarray) -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0][code]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text, or None if it has no letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _letters(code)
    if not is_letter.any():
        return None
    code = np.where(is_letter, code, 0)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]  # one boundary between words
    c = np.concatenate([[0], code[keep], [0]]).astype(np.uint64)
    out = np.zeros(DIM, dtype=np.int64)
    for at in range(0, len(c), _CHUNK):
        for n in (1, 2, 3):
            x = c[at:at + _CHUNK + n - 1]
            if len(x) < n:
                continue
            h = x[:len(x) - n + 1] + np.uint64(n)
            for j in range(1, n):
                h = h * np.uint64(0x100000001B3) + x[j:len(x) - n + 1 + j]
            if n == 1:
                h = h[x != 0]
            h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)  # the top 13 bits
            out += np.bincount(h.astype(np.int64), minlength=DIM)
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, tries: int = 8, seed: int = 11) -> np.ndarray:
    """At most k centroids of unit rows, none of less than LEAST_SHARE of the rows if k > 1.

    Starts are drawn with a chance that grows with the distance from those
    drawn before (k-means++); a centroid of too few rows starts anew at a row
    drawn from the largest cluster, and is dropped if it stays small. The
    draws are seeded, so runs agree.
    """
    rng = np.random.default_rng(seed)
    chosen = [int(np.argmax(x @ _unit(x.mean(axis=0))))]
    while len(chosen) < min(k, len(x)):
        far = np.clip(1 - (x @ x[chosen].T).max(axis=1), 0, None)
        if far.sum() <= 1e-9:
            break  # fewer different rows than centroids
        chosen.append(int(rng.choice(len(x), p=far / far.sum())))
    c = x[chosen]
    for t in range(tries):
        for _ in range(rounds):
            best = np.argmax(x @ c.T, axis=1)
            c = _unit(np.stack([x[best == j].mean(axis=0) if (best == j).any() else c[j] for j in range(len(c))]))
        size = np.bincount(np.argmax(x @ c.T, axis=1), minlength=len(c))
        small = np.flatnonzero(size < LEAST_SHARE * len(x))
        if len(c) == 1 or not len(small):
            break
        if t == tries - 1:
            c = np.delete(c, small, axis=0) if len(small) < len(c) else c[[int(size.argmax())]]
            break
        largest = np.flatnonzero(np.argmax(x @ c.T, axis=1) == size.argmax())
        c[small] = x[rng.choice(largest, len(small))]
    return c


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    owner: np.ndarray  # language number of each centroid
    centroids: np.ndarray
    radius: np.ndarray  # least cosine that is accepted, by language

    def vectors(self, counts: list[np.ndarray]) -> np.ndarray:
        return _unit(np.log1p(np.stack(counts)).astype(np.float32) * self.idf)

    def vectors_of(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Which texts have a letter, and the vectors of those; one text's counts at a time."""
        ok, x = np.zeros(len(texts), dtype=bool), np.empty((len(texts), DIM), dtype=np.float32)
        for i, t in enumerate(texts):
            counts = gram_counts(t)
            if counts is not None:
                ok[i], x[i] = True, np.log1p(counts)
        return ok, _unit(x[ok] * self.idf)

    def cosines(self, x: np.ndarray) -> np.ndarray:
        """Largest cosine with each language's centroids."""
        sims = x @ self.centroids.T
        return np.stack([sims[:, self.owner == i].max(axis=1) for i in range(len(self.languages))], axis=1)

    def judge(self, texts: list) -> pd.DataFrame:
        """lang_pred, score, cosine and rejected of each text."""
        parts = [self._judge(texts[at:at + _TEXTS]) for at in range(0, len(texts), _TEXTS)]
        return pd.concat(parts or [self._judge([])], ignore_index=True)

    def _judge(self, texts: list) -> pd.DataFrame:
        ok, x = self.vectors_of(texts if self.languages else [None] * len(texts))
        lang = np.full(len(texts), NO_LANGUAGE, dtype=object)
        score, cosine, rejected = np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        if ok.any():
            cos = self.cosines(x)
            best = cos.argmax(axis=1)
            top = cos[np.arange(len(best)), best]
            lang[ok] = np.array(self.languages, dtype=object)[best]
            score[ok] = 1 / np.exp(SHARPNESS * (cos - top[:, None])).sum(axis=1)
            cosine[ok], rejected[ok] = top, top < self.radius[best]
        return pd.DataFrame(dict(zip(JUDGED, (lang, score, cosine, rejected))))


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` different labelled texts (lang, text) of each language, those with the least hashes.

    However often a text is repeated, it counts once. Only languages and
    hashes are ranked, and of those about twice the wanted number, by a share
    that comes from the count of all different texts.
    """
    hashed = stash(rows.select("lang", F.xxhash64("text").alias("h")).distinct(), "text-hashes")
    bound = F.lit(float(1 << 63)) * 2 * (F.least(F.lit(1.0), 2.0 * per_language / F.col("n")) - 0.5)
    bounds = broadcast_small(stash(hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")).select("lang", bound.alias("bound"))
    near = hashed.join(bounds, "lang").where(F.col("h").cast("double") <= F.col("bound")).select("lang", "h")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    least = near.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")
    least = broadcast_small(stash(least, "sampled-texts")).alias("b")
    texts = rows.alias("a").join(least, (F.col("a.lang") == F.col("b.lang")) & (F.xxhash64("a.text") == F.col("b.h")))
    return texts.groupBy(F.col("a.lang").alias("lang"), F.col("b.h").alias("h")).agg(F.min("a.text").alias("text"))


def fit_language_model(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", per_language: int = SAMPLE, k: int = CENTROIDS) -> LanguageModel:
    """Fit on ``per_language`` texts at most of each language among the rows where ``train`` holds.

    Rows with a null text or language are left out, and repeated texts of a
    language count once; without any labelled text the model has no
    languages. Ids are read by ``train`` only; other columns not at all.
    """
    rows = docs.where(train).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("text is not null and lang is not null")

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [gram_counts(t) for t in f["text"]]
            ok = [c is not None for c in got]
            at = [np.flatnonzero(c) for c in got if c is not None]
            yield pd.DataFrame({"lang": f["lang"][ok].to_numpy(), "at": at,
                                "tf": [np.log1p(c[a]).astype(np.float32) for c, a in zip((c for c in got if c is not None), at)]})

    feats = _sample(rows, per_language).select("lang", "text").mapInPandas(
        grams, "lang string, at array<int>, tf array<float>").persist()
    total = feats.count()
    df = np.zeros(DIM)
    for r in feats.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # DIM rows at most
        df[r["at"]] = r["count"]
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def cluster(f: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(f), DIM), dtype=np.float32)
        for i, (a, t) in enumerate(zip(f["at"], f["tf"])):
            x[i, a] = t
        x = _unit(x * idf)
        c = spherical_kmeans(x, k)
        least = float(np.quantile((x @ c.T).max(axis=1), TAIL))
        return pd.DataFrame({"lang": f["lang"].iloc[0], "centroid": list(c), "least": least})

    found = feats.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, least double").collect()
    feats.unpersist()
    names = sorted({r["lang"] for r in found})
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    return LanguageModel(
        idf, names, np.array([names.index(r["lang"]) for r in found], dtype=int),
        np.array([r["centroid"] for r in found], dtype=np.float32).reshape(-1, DIM),
        np.array([SLACK * min(r["least"] for r in found if r["lang"] == n) for n in names]))


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, cosine, rejected.

    Null texts and texts without a letter get ``und``, score 0, and are
    rejected, as is every text if the model has no languages. Ties go to the
    first language by name. Repeated rows are predicted alike; no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages * CENTROIDS * DIM floats

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):  # a batch's texts are never all Python strings at once
                b = batch.slice(at, _TEXTS)
                f = sent.value.judge(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(f[c], k) for c, k in zip(
                    JUDGED, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]], names=["id", *JUDGED])

    cols = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    return cols.mapInArrow(predict, f"id {kind}, lang_pred string, score double, cosine double, rejected boolean")


def drop_unidentified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected; null texts and texts without a letter go."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_by_text(docs, text_col, lambda texts: ~sent.value.judge(texts)["rejected"].to_numpy())
