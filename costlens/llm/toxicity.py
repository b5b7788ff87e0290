"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel compares two words by the subsequences of three letters that they
share, gaps allowed, each weighted by ``DECAY`` to the number of letters
skipped, and is scaled so that a word has similarity 1 with itself. A word is
the letters of a run without white space; other characters inside it are
skipped, and runs of single letters ("i d i o t") are one word, so that
inserted characters, gaps and spaces leave most subsequences in place.

A Nystroem map through landmark words makes the kernel linear: the machine is
fitted on labelled sentences there, a sentence counting by its worst word. A
sentence has the label of its document; as not every sentence of a toxic
document is toxic, only those that the machine finds so (the worst one at
least) are held positive in the next pass. The fitted machine is one weight for
each letter triple, so a word is judged by table lookups. A logistic curve,
fitted on other labelled documents, turns the worst words of a document and
their number into its score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled documents of each kind (toxic, other) that the machine and its curve are fitted on, at most.
SAMPLE = 2_400
# Sentences of a sampled document that are learned from, at most, and words of a sentence.
SENTENCES = 40
SENTENCE_WORDS = 40
LANDMARKS = 256
DECAY = 0.5
# Distances between the three letters of a subsequence.
STEPS = ((1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1))
# Letters of a word that are looked at together; a longer one is covered by overlapping windows.
WINDOW, STRIDE = 24, 12
DECISION = 0.5
# Margins up to here count as none.
FLOOR = -0.9
PASSES = 5
_EDGE, _CLASSES, _OTHER = 63, 64, 36
_PIECE = 1 << 20
_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Per code point: 1 to 62 for letters (a-z apart, others hashed), 0 for other characters, 255 for white space."""
    if not _CLASS:
        points = np.arange(0x110000, dtype=np.uint64)
        out = np.zeros(0x110000, dtype=np.uint8)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        hashed = 27 + ((points * np.uint64(2654435761)) >> np.uint64(12)) % np.uint64(_OTHER)
        out[alpha] = hashed[alpha].astype(np.uint8)
        out[97:123] = np.arange(1, 27)
        out[[i for i in range(0x3001) if chr(i).isspace()]] = 255
        _CLASS.append(out)
    return _CLASS[0]


def _pieces(texts: list) -> Iterator[tuple[str, list[int], list[int]]]:
    """Texts joined up to a bounded length (joined text, end of each piece, its owner); long ones are cut, with overlap."""
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        at = 0
        while at < len(text):
            end = min(at + _PIECE, len(text))
            parts.append(text[at:end])
            owners.append(i)
            size += end - at
            at = end if end == len(text) else end - 2 * WINDOW
            if size >= _PIECE:
                yield "\n".join(parts), list(np.cumsum([len(p) + 1 for p in parts])), owners
                parts, owners, size = [], [], 0
    if parts:
        yield "\n".join(parts), list(np.cumsum([len(p) + 1 for p in parts])), owners


def windows(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, rows) of the words of texts, in order: rows of letter classes between edge marks, 0 where there is none.

    All of a text is covered; words of one or two letters are left out.
    """
    for joined, ends, owners in _pieces(texts):
        cls = _classes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        space = cls == 255
        begin = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        stop = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
        letter_at = np.flatnonzero((cls > 0) & ~space)
        first, last = np.searchsorted(letter_at, begin), np.searchsorted(letter_at, stop)
        owner = np.searchsorted(np.asarray(ends), begin, side="right")
        has = last > first
        first, last, owner = first[has], last[has], owner[has]
        if not len(first):
            continue
        # Runs of three or more single letters in one text are one word.
        single = last - first == 1
        new_run = ~single | np.concatenate([[True], ~single[:-1] | (owner[1:] != owner[:-1])])
        run = np.cumsum(new_run) - 1
        head = np.flatnonzero(new_run)
        first, last, owner = first[head], last[np.concatenate([head[1:], [len(run)]]) - 1], owner[head]
        n = last - first
        keep = n >= 3
        first, n, owner = first[keep], n[keep], owner[keep]
        count = np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1)
        word = np.repeat(np.arange(len(n)), count)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        offset = nth * STRIDE
        length = np.minimum(n[word] - offset, WINDOW)
        letters = np.concatenate([cls[letter_at], np.zeros(WINDOW, dtype=np.uint8)])
        spot = np.arange(WINDOW)
        who = np.asarray(owners)[owner[word]]
        for at in range(0, len(word), 1 << 17):
            w = slice(at, at + (1 << 17))
            rows = np.zeros((len(word[w]), WINDOW + 2), dtype=np.uint8)
            got = letters[(first[word[w]] + offset[w])[:, None] + spot]
            rows[:, 1:-1] = np.where(spot < length[w][:, None], got, 0)
            rows[:, 0] = np.where(offset[w] == 0, _EDGE, 0)
            ends_word = offset[w] + length[w] == n[word[w]]
            rows[np.flatnonzero(ends_word), 1 + length[w][ends_word]] = _EDGE
            yield who[w], rows


def triples(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, weight) of all letter triples of each row; code 0 where there is none."""
    codes, weights = [], []
    width = rows.shape[1]
    r = rows.astype(np.int32)
    for a, b in STEPS:
        if width <= a + b:
            continue
        x, y, z = r[:, :width - a - b], r[:, a:width - b], r[:, a + b:]
        codes.append(np.where((x > 0) & (y > 0) & (z > 0), (x * _CLASSES + y) * _CLASSES + z, 0))
        weights.append(np.full(width - a - b, DECAY ** (a + b - 2), dtype=np.float32))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


def _norms(code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square root of each row's similarity with itself; equal triples of a row add up first."""
    order = np.argsort(code, axis=1, kind="stable")
    c = np.take_along_axis(code, order, axis=1)
    w = np.where(c > 0, weight[order], 0).astype(np.float64)
    total = np.cumsum(w, axis=1)
    last = np.concatenate([c[:, 1:] != c[:, :-1], np.ones((len(c), 1), dtype=bool)], axis=1)
    upto = np.maximum.accumulate(np.where(last, total, 0), axis=1)
    before = np.concatenate([np.zeros((len(c), 1)), upto[:, :-1]], axis=1)
    return np.sqrt((np.where(last, total - before, 0) ** 2).sum(axis=1))


def _narrow(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index, rows) by length of the words, without the columns that only longer ones fill."""
    length = (rows > 0).sum(axis=1) + (rows[:, 0] == 0)
    for lo, hi in ((0, 9), (9, 14), (14, WINDOW + 2)):
        at = np.flatnonzero((length > lo) & (length <= hi))
        if len(at):
            yield at, rows[at, :hi]


def margins(rows: np.ndarray, table: np.ndarray, bias: float, floor: float = FLOOR) -> np.ndarray:
    """The machine's margin of each row; margins up to ``floor`` come as ``floor``."""
    out = np.full(len(rows), floor)
    for at, part in _narrow(rows):
        code, weight = triples(part)
        dot = (table[code] * weight).sum(axis=1)
        # Without adding up equal triples the norm is no larger, so this bounds the margin from above.
        least = np.sqrt(((code > 0) * weight ** 2).sum(axis=1))
        near = np.flatnonzero((dot > 0) & (dot > (floor - bias) * least))
        if len(near):
            out[at[near]] = np.maximum(dot[near] / _norms(code[near], weight) + bias, floor)
    return out


def similarities(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each row with each landmark row."""
    lc, lw = triples(landmarks)
    spread = np.zeros((_CLASSES ** 3, 1), dtype=np.int32)
    used = np.unique(lc[lc > 0])
    spread[used, 0] = np.arange(1, len(used) + 1)
    m = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
    np.add.at(m, (spread[lc, 0], np.arange(len(landmarks))[:, None]), np.broadcast_to(lw, lc.shape))
    m[0] = 0
    m /= np.linalg.norm(m, axis=0)
    out = np.zeros((len(rows), len(landmarks)), dtype=np.float32)
    for at in range(0, len(rows), 2048):
        code, weight = triples(rows[at:at + 2048])
        x = np.zeros((len(code), len(used) + 1), dtype=np.float32)
        np.add.at(x, (np.arange(len(code))[:, None], spread[code, 0]), np.broadcast_to(weight, code.shape))
        out[at:at + 2048] = x @ m / np.maximum(_norms(code, weight), 1e-12)[:, None]
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, reg: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of the least squared hinge loss, by Newton steps on the rows inside the margin."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], reg)
    ridge[-1] = 1e-3 * reg
    inside = np.ones(len(z), dtype=bool)
    for _ in range(steps):
        zi, ci = z[inside], cost[inside]
        w = np.linalg.solve((zi * ci[:, None]).T @ zi + np.diag(ridge), (zi * ci[:, None]).T @ y[inside])
        now = y * (z @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w[:-1], float(w[-1])


@dataclass
class ToxicityModel:
    table: np.ndarray  # weight of each letter triple
    bias: float
    curve: np.ndarray  # of the document's features and 1
    landmarks: list[str]

    def features(self, texts: list) -> np.ndarray:
        """Per text: the two largest margins, the number of words past the margin and their share."""
        n = len(texts)
        top = np.full((n, 2), FLOOR)
        hits, words = np.zeros(n), np.zeros(n)
        for owner, rows in windows(texts):
            m = margins(rows, self.table, self.bias)
            words += np.bincount(owner, minlength=n)
            hits += np.bincount(owner[m > 0], minlength=n)
            at = np.flatnonzero(m > FLOOR)
            at = at[np.lexsort((-m[at], owner[at]))]
            rank = np.arange(len(at)) - np.searchsorted(owner[at], owner[at])
            for k in (0, 1):
                best = at[rank == k]
                low = m[best]
                # Merge into the two largest so far.
                a, b = top[owner[best], 0].copy(), top[owner[best], 1].copy()
                top[owner[best], 0] = np.maximum(a, low)
                top[owner[best], 1] = np.maximum(b, np.minimum(a, low))
        return np.column_stack([np.clip(top, FLOOR, 1.5), np.log1p(hits), np.sqrt(hits / np.maximum(words, 1))])

    def judge(self, texts: list) -> np.ndarray:
        """Score of each text."""
        z = self.features(texts) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _constant(score: float) -> ToxicityModel:
    p = min(max(score, 1e-6), 1 - 1e-6)
    return ToxicityModel(np.zeros(_CLASSES ** 3, dtype=np.float32), -1.0, np.array([0, 0, 0, 0, np.log(p / (1 - p))]), [])


_SENTENCE = re.compile(r"[.!?\n]+")


def sentences(text: str | None, limit: int = SENTENCES, words: int = SENTENCE_WORDS) -> list[str]:
    """Distinct sentences of a text, long ones in runs of words; of more than ``limit``, those with the least checksum."""
    out = set()
    for s in _SENTENCE.split(text or ""):
        w = s.split()
        for at in range(0, len(w), words):
            out.add(" ".join(w[at:at + words])[:8 * WINDOW * words])
    return sorted(out, key=lambda s: (zlib.crc32(s.encode("utf-8", "surrogatepass")), s))[:limit]


def _words(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()


def choose_landmarks(rows: np.ndarray, docs: np.ndarray, toxic: np.ndarray, count: int) -> np.ndarray:
    """Indices of landmark rows: half are words that toxic documents have more often, unlike each other, half are of other documents."""
    seen, word = np.unique(_words(rows), return_inverse=True)
    pair = np.unique(np.stack([word, docs]), axis=1)  # each word once a document
    is_toxic = toxic[pair[1]]
    t = np.bincount(pair[0][is_toxic], minlength=len(seen)) / max(toxic.sum(), 1)
    c = np.bincount(pair[0][~is_toxic], minlength=len(seen)) / max((~toxic).sum(), 1)
    first = np.zeros(len(seen), dtype=np.int64)
    first[word[::-1]] = np.arange(len(word))[::-1]
    lift = t - 3 * c
    ranked = first[np.lexsort((seen, -lift))[:8 * count]]
    near = similarities(rows[ranked], rows[ranked])
    chosen: list[int] = []
    for i in range(len(ranked)):
        if len(chosen) < count // 2 and (not chosen or near[i, chosen].max() < 0.8):
            chosen.append(i)
    plain = first[np.flatnonzero(c > 0)]
    order = np.argsort([zlib.crc32(rows[i].tobytes()) for i in plain], kind="stable")
    picked = np.concatenate([ranked[chosen], plain[order[:count - len(chosen)]]])
    return picked[np.sort(np.unique(_words(rows[picked]), return_index=True)[1])]


def fit_machine(docs: list[list[str]], toxic: np.ndarray, landmarks: int = LANDMARKS, passes: int = PASSES):
    """(table, bias, landmark rows) from the sentences of documents and the documents' labels."""
    flat = [s for d in docs for s in d]
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    got = list(windows(flat))
    if not got:
        return None
    sentence, rows = np.concatenate([o for o, _ in got]), np.concatenate([r for _, r in got])
    doc = doc_of[sentence]
    if not toxic[doc].any() or toxic[doc].all():
        return None
    marks = rows[choose_landmarks(rows, doc, toxic, landmarks)]
    value, vector = np.linalg.eigh(similarities(marks, marks).astype(np.float64))
    keep = value > 1e-4 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    code, weight = triples(marks)
    norm = _norms(code, weight)
    # The worst word of a sentence is at first the one most like a landmark that toxic documents have more often.
    lead = marks[:max(1, landmarks // 4)]
    m = np.concatenate([similarities(rows[i:i + 100_000], lead).max(axis=1) for i in range(0, len(rows), 100_000)])
    start = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
    label = toxic[doc[start]]
    table, bias = None, 0.0
    for p in range(passes):
        order = np.lexsort((np.arange(len(m)), -m, sentence))
        best = order[start]
        top = m[best]
        cut = np.quantile(top[~label], 0.99) if p == 0 else 0.0
        worst = np.full(len(toxic), -np.inf)
        np.maximum.at(worst, doc[best], top)
        hold = ~label | (top > cut) | (top >= worst[doc[best]])
        at = best[hold]
        y = np.where(label[hold], 1.0, -1.0)
        cost = np.where(y > 0, 1.0 / max((y > 0).sum(), 1), 1.0 / max((y < 0).sum(), 1)) * 200
        z = similarities(rows[at], marks).astype(np.float64) @ root
        w, bias = fit_svm(z, y, cost)
        beta = root @ w / norm
        table = np.zeros(_CLASSES ** 3)
        np.add.at(table, code, beta[:, None] * weight)
        table[0] = 0
        table = table.astype(np.float32)
        m = margins(rows, table, bias, floor=-5.0)
    return table, bias, marks


def fit_curve(x: np.ndarray, y: np.ndarray, reg: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps; the features are not let lower the score."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    free = np.ones(z.shape[1], dtype=bool)
    while True:
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z[:, free] @ w[free], -30, 30)))
            ridge = np.full(free.sum(), reg)
            grad = z[:, free].T @ (p - y) + ridge * w[free]
            h = (z[:, free] * (p * (1 - p) + 1e-9)[:, None]).T @ z[:, free] + np.diag(ridge)
            step = np.linalg.solve(h, grad)
            w[free] -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        bad = np.flatnonzero(w[:-1] < 0)
        if not len(bad):
            return w
        free[bad] = False


def labelled_texts(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str,
                       sample: int) -> DataFrame:
    """(id, toxic, text) of ``sample`` documents at most of each label."""
    marks = labels.where(train).where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    pick = lambda y: marks.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(sample)
    wanted = pick(1).unionByName(pick(0))  # 2 * sample rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(wanted), "id")
    # Of several texts under one id, the one with the least hash.
    return texts.groupBy("id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Fit on ``sample`` labelled documents at most of each kind, half for the machine, half for the curve.

    ``train`` is a condition on the id column; rows where it does not hold
    (or is null) teach nothing. Samples are the ids with the smallest hash. A
    document is toxic if any of its labels says so; labels other than 0 and 1,
    null ids and labels without a document teach nothing. Without documents
    of both kinds every text scores the share of toxic ones (0 without any).
    """
    rows = labelled_texts(docs, labels, train, id_col, text_col, label_col, sample)

    def said(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"].astype(str), "toxic": f["toxic"], "said": [sentences(t) for t in f["text"]]})

    got = rows.mapInPandas(said, "id string, toxic int, said array<string>").collect()
    got.sort(key=lambda r: (zlib.crc32(r["id"].encode()), r["id"]))
    toxic = np.array([r["toxic"] == 1 for r in got], dtype=bool)
    if not toxic.any() or toxic.all():
        return _constant(float(toxic.mean()) if len(toxic) else 0.0)
    half = np.zeros(len(got), dtype=bool)
    for kind in (True, False):
        half[np.flatnonzero(toxic == kind)[::2]] = True
    fitted = fit_machine([list(r["said"]) for r, h in zip(got, half) if h], toxic[half])
    if fitted is None:
        return _constant(float(toxic.mean()))
    table, bias, marks = fitted
    model = ToxicityModel(table, bias, np.zeros(5), ["".join(chr(96 + c) if 0 < c < 27 else "." for c in m if c and c != _EDGE) for m in marks])
    rest = ~half if (toxic & ~half).any() and (~toxic & ~half).any() else half
    x = model.features(["\n".join(r["said"]) for r, h in zip(got, rest) if h])
    model.curve = fit_curve(x, toxic[rest].astype(np.float64))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 from 0.5). Null and empty texts score as texts without words.

    Whole texts are read, long ones in pieces. Repeated rows score alike;
    other columns are left out; no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a table of 64^3 weights

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            s = sent.value.judge(f["text"].tolist())
            yield pd.DataFrame({"id": f["id"], "score": s, "predicted": (s >= DECISION).astype(np.int32)})

    cols = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    return cols.mapInPandas(run, f"id {kind}, score double, predicted int")
