"""Quality classifier from trusted positives and unlabelled text (non-negative PU learning).

Texts become surface features: shares of characters by kind, of repeated
words, word pairs and lines, word lengths, and the same over the worst window
of the text. A small network is fitted by the non-negative unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

with positives P trusted by their label, unlabelled text U, and the prior of
the positive class, which is estimated as the share of positives among the
labelled rows. Labelled rows also set where on the network's scale the score
0.7, the decision, falls.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import filter_by_text
from costlens.llm.shingles import _SPACE, CHUNK, word_hashes

# Rows of each kind (positive, unlabelled, labelled) that the model is fitted on, at most.
SAMPLE = 6000
DECISION = 0.7
HIDDEN = 24
WINDOW = 64  # words
_PUNCT = np.frombuffer(string.punctuation.encode(), dtype=np.uint8)
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
N_FEATURES = len(_PUNCT) + 18


def features(text: str | None) -> np.ndarray:
    """Feature vector of a whole text; zeros for null or empty."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    words = word_hashes(text)
    if not len(words):
        return out
    hist = np.zeros(256, dtype=np.int64)
    b = np.frombuffer(data, dtype=np.uint8)
    upper_runs = 0
    for at in range(0, len(b), CHUNK):
        part = b[at:at + CHUNK]
        hist += np.bincount(part, minlength=256)
        up = (part >= 65) & (part <= 90)
        upper_runs += int((up[1:] & up[:-1]).sum())
    n, w = len(b), len(words)
    letters = hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum()
    _, counts = np.unique(words, return_counts=True)
    pairs = words[1:] * np.uint64(3) ^ words[:-1]
    same = words[1:] == words[:-1]
    lines = [x for x in text.split("\n") if x.strip()]
    tail = np.zeros(18, dtype=np.float64)
    tail[:12] = (np.log1p(w) / 10, n / w / 10, hist[_UPPER].sum() / n, hist[_DIGIT].sum() / n, letters / n,
                 hist[128:].sum() / n, hist[10] / w, len(counts) / w, counts.max() / w,
                 same.mean() if w > 1 else 0, len(np.unique(pairs)) / max(len(pairs), 1),
                 len(set(lines)) / max(len(lines), 1))
    tail[12] = upper_runs / max(letters, 1)
    # The worst window: repeats of the word before, and few distinct words.
    if w > 1:
        run = np.concatenate([[0], np.cumsum(same)])
        k = min(WINDOW, len(same))
        at = np.arange(0, len(same) - k + 1, max(1, k // 4))
        tail[13] = (run[at + k] - run[at]).max() / k
    # Words that end in punctuation, and words of one character.
    ends, single, punct_only = _word_ends(b)
    tail[14:18] = ends / w, single / w, punct_only / w, hist[_PUNCT].sum() / n
    out[:len(_PUNCT)] = np.sqrt(hist[_PUNCT] / w)
    out[len(_PUNCT):] = tail
    return out


_BLANK = np.frombuffer(b" ", dtype=np.uint8)
_IS_PUNCT = np.zeros(256, dtype=bool)
_IS_PUNCT[_PUNCT] = True


def _word_ends(b: np.ndarray) -> tuple[int, int, int]:
    """Words that end in punctuation, one-byte words, and one-byte words that are punctuation."""
    ends = single = alone = 0
    for at in range(0, len(b), CHUNK):
        # With the byte before and after the chunk, or white space at the ends of the text.
        before = b[at - 1:at] if at else _BLANK
        after = b[at + CHUNK:at + CHUNK + 1] if at + CHUNK < len(b) else _BLANK
        part = np.concatenate([before, b[at:at + CHUNK], after])
        space, punct = _SPACE[part], _IS_PUNCT[part]
        last = ~space[1:-1] & space[2:]
        one = last & space[:-2]
        ends += int((last & punct[1:-1]).sum())
        single += int(one.sum())
        alone += int((one & punct[1:-1]).sum())
    return ends, single, alone


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float
    cut: float = 0.0  # the network's output at the decision

    def raw(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(DECISION / (1 - DECISION)) - self.cut
        return 1 / (1 + np.exp(-np.clip(self.raw(x) + shift, -30, 30)))

    def judge(self, texts: list) -> np.ndarray:
        """Score of each text."""
        return self.score(np.array([features(t) for t in texts], dtype=np.float64).reshape(-1, N_FEATURES))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, epochs: int = 40, batch: int = 512,
             rate: float = 5e-3, seed: int = 7) -> QualityModel:
    """Minimise the non-negative risk with the logistic loss by Adam over mini-batches."""
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (pos - mean) / scale, (unl - mean) / scale
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    w = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    steps = max(1, max(len(p), len(u)) // batch)
    for _ in range(epochs):
        ip, iu = rng.permutation(len(p)), rng.permutation(len(u))
        for s in range(steps):
            xp, xu = p[ip[s::steps]], u[iu[s::steps]]
            if not len(xp) or not len(xu):
                continue
            hp, hu = np.tanh(xp @ w[0] + w[1]), np.tanh(xu @ w[0] + w[1])
            zp, zu = hp @ w[2] + w[3], hu @ w[2] + w[3]
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp = (-prior * _sigmoid(-zp) - prior * _sigmoid(zp)) / len(zp)
                gu = _sigmoid(zu) / len(zu)
            else:  # step against the part that has become negative
                gp = prior * _sigmoid(zp) / len(zp)
                gu = -_sigmoid(zu) / len(zu)
            g, h, x = np.concatenate([gp, gu]), np.concatenate([hp, hu]), np.concatenate([xp, xu])
            back = np.outer(g, w[2]) * (1 - h * h)
            grads = [x.T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ g + 1e-4 * w[2], np.array([g.sum()])]
            t += 1
            for i, q in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * q
                v[i] = 0.999 * v[i] + 0.001 * q * q
                w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return QualityModel(mean, scale, w, prior)


def best_cut(raw: np.ndarray, label: np.ndarray) -> float:
    """The middle of the gap at which positives and negatives are told apart best, both classes weighing the same."""
    if not (label == 1).any() or not (label == 0).any():
        return float(raw.min() - 1) if len(raw) and (label == 1).all() else 0.0
    order = np.argsort(raw, kind="stable")
    r, y = raw[order], label[order]
    # Cut after i values: negatives below are right, positives above are right.
    right = np.concatenate([[0], np.cumsum(y == 0)]) / (y == 0).sum() + \
        1 - np.concatenate([[0], np.cumsum(y == 1)]) / (y == 1).sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    i = int(best[len(best) // 2])
    lo, hi = r[max(i - 1, 0)], r[min(i, len(r) - 1)]
    return float((lo + hi) / 2)


def _featured(rows: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "x": [features(t) for t in f["text"]]})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInPandas(run, f"id {kind}, x array<float>")


def fit_quality_model(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Fit on ``sample`` rows at most of each kind: trusted positives, unlabelled texts, labelled rows.

    ``train`` is a condition on the id column; rows where it does not hold
    (or is null) teach nothing. Samples are the rows with the smallest hash
    of their id. The prior counts all training labels. An id labelled both 0
    and 1 is a positive and a negative; null texts count as empty ones.
    Without positives or without documents every text scores alike.
    """
    known = labels.where(train).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    n = known.agg(F.count("*"), F.sum("y")).first()
    prior = min(0.99, max(0.01, (n[1] or 0) / n[0])) if n[0] else 0.5
    pick = lambda rows, salt: rows.select("id").distinct().orderBy(
        F.xxhash64("id", F.lit(salt)), "id").limit(sample)
    ids = docs.where(train).select(F.col(id_col).alias("id")).where("id is not null")
    kinds = {"p": pick(known.where("y = 1"), 1), "u": pick(ids, 2), "0": pick(known.where("y = 0"), 3)}
    wanted = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("kind", F.lit(kind))
        wanted = rows if wanted is None else wanted.unionByName(rows)
    wanted = wanted.groupBy("id").agg(F.collect_set("kind").alias("kinds"))  # 3 * sample rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(wanted.select("id")), "id")
    # Of several texts under one id, the one with the least hash, so that the model does not hang on the layout.
    texts = texts.groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    got = _featured(texts).join(wanted, "id").orderBy("id").collect()
    x = {k: np.array([r["x"] for r in got if k in r["kinds"]], dtype=np.float64).reshape(-1, N_FEATURES) for k in kinds}
    if not len(x["p"]) or not len(x["u"]):
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES),
                            [np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(1)], prior)
    model = fit_nnpu(x["p"], x["u"], prior)
    known_x = np.concatenate([x["p"], x["0"]])
    model.cut = best_cut(model.raw(known_x), np.repeat([1, 0], [len(x["p"]), len(x["0"])]))
    return model


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 from 0.7). Null and empty texts score as texts without words.

    Repeated rows score alike; other columns are left out; no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            s = sent.value.judge(f["text"].tolist())
            yield pd.DataFrame({"id": f["id"], "score": s, "predicted": (s >= DECISION).astype(np.int32)})

    cols = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    return cols.mapInPandas(run, f"id {kind}, score double, predicted int")


def drop_low_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least the decision; null texts score as empty ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_by_text(docs, text_col, lambda texts: sent.value.judge(texts) >= DECISION)
