"""Main text of HTML pages by a recurrent block labeller.

A page is read as its sequence of text blocks. Each block is a vector: the
hashed words of its tag path (tags, classes, ids, roles), its hashed words,
and a few measures (length, link share, place). A bidirectional LSTM in numpy
reads the whole sequence and labels every block as main text or not, so a
block is judged by what surrounds it.

The labeller is trained here, on pages composed from text of the corpus in
many layouts whose main part is known, and on a bounded sample of the
corpus's pages that mark their article themselves.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.html_blocks import PATH_DIM, Block, blocks
from costlens.llm.shingles import word_hashes

# Pages that the labeller is trained on: sampled ones (of at most SAMPLE_CHARS characters) and composed ones.
SAMPLE, SAMPLE_CHARS, COMPOSED = 150, 50_000, 1500
WORD_DIM, N_MEASURES = 32, 10
DIM = PATH_DIM + WORD_DIM + N_MEASURES
HIDDEN = 24
# Blocks of pages that are labelled together, and blocks of a page that are taken at a time.
BATCH, STEPS = 1 << 14, 256

# Fixed words of class names and layouts by which composed pages are made and marked pages are read.
MAIN_NAMES = ("content", "article", "post", "entry", "story", "body", "main", "text", "page-content", "article-body",
              "post-content", "entry-content", "story-body", "main-content", "article-text", "blog-post")
NOTICE_NAMES = ("cookie", "cookie-notice", "notice", "banner", "consent", "alert", "gdpr", "cookie-banner", "popup",
                "message", "warning", "subscribe", "paywall", "announcement")
HEADER_NAMES = ("header", "top", "masthead", "site-header", "branding", "topbar", "logo")
MENU_NAMES = ("menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "links", "main-menu", "topnav")
ADVERT_NAMES = ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "adsbox", "ad-slot",
                "banner-ad", "promoted", "adslot")
SIDE_NAMES = ("sidebar", "side", "widget", "related", "more", "teaser", "recommended", "popular", "trending",
              "related-posts", "aside", "newsletter")
COMMENT_NAMES = ("comments", "comment", "comment-list", "commentlist", "replies", "discussion", "responses",
                 "user-comments", "reader-comments", "reply", "disqus", "feedback")
FOOTER_NAMES = ("footer", "copyright", "legal", "site-footer", "bottom", "colophon", "imprint")
SHARE_NAMES = ("share", "social", "sharing", "share-buttons", "tools", "tags", "meta-links")
MAIN_TAGS = ("article", "main")
OTHER_TAGS = ("nav", "aside", "footer", "header", "form", "button", "select", "fieldset", "dialog", "menu")
_OTHER_WORDS = frozenset(w for names in (NOTICE_NAMES, HEADER_NAMES, MENU_NAMES, ADVERT_NAMES, SIDE_NAMES, COMMENT_NAMES,
                                         FOOTER_NAMES, SHARE_NAMES) for n in names for w in n.split("-")) - {"main", "top", "more"}


@lru_cache(maxsize=1 << 14)
def _path_vector(bits: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits.to_bytes(PATH_DIM // 8, "little"), dtype=np.uint8), bitorder="little")


def block_vectors(page: list[Block], lo: int = 0, hi: int | None = None) -> np.ndarray:
    """One row of DIM numbers for each block of a page, or for those from ``lo`` to before ``hi``."""
    whole, page = len(page), page[lo:hi]
    x = np.zeros((len(page), DIM), dtype=np.float32)
    if not page:
        return x
    for i, b in enumerate(page):
        if b.within:
            x[i, :PATH_DIM] = _path_vector(b.within.vector_bits())
    n = np.array([b.text.count(" ") + 1 for b in page])
    chars = np.array([len(b.text) for b in page])
    words = word_hashes(" ".join(b.text for b in page)) >> np.uint64(59)  # 32 slots
    of = np.repeat(np.arange(len(page)), n)
    counts = np.bincount(of * WORD_DIM + words.astype(np.int64), minlength=len(page) * WORD_DIM)
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = counts.reshape(-1, WORD_DIM) / n[:, None]
    at = np.arange(lo, lo + len(page))
    x[:, PATH_DIM + WORD_DIM:] = np.stack([
        np.log1p(n) / 5, np.log1p(chars) / 7, np.minimum(1, [b.linked for b in page] / chars),
        [b.text[-1] in ".!?" for b in page], np.minimum([b.tags for b in page], 10) / 10, at == 0, at == whole - 1,
        at / whole, np.full(len(page), np.log1p(whole) / 6), n <= 3], axis=1)
    return x


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def _run(x, mask, w, u, b):
    """States of an LSTM over x (time, batch, DIM); steps outside the mask keep the state."""
    steps, batch = mask.shape
    h = c = np.zeros((batch, u.shape[0]), dtype=np.float32)
    zx = x @ w + b
    saved = []
    for t in range(steps):
        z = zx[t] + h @ u
        i, f, o, g = np.split(z, 4, axis=1)
        i, f, o, g = _sigmoid(i), _sigmoid(f + 1), _sigmoid(o), np.tanh(g)
        m = mask[t][:, None]
        c2 = f * c + i * g
        tc = np.tanh(c2)
        saved.append((i, f, o, g, c, h, tc))
        c, h = m * c2 + (1 - m) * c, m * o * tc + (1 - m) * h
        saved[-1] += (h,)
    return saved


def _back(x, mask, w, u, saved, dout):
    """Gradients of w, u and b from those of the states."""
    steps, batch = mask.shape
    n = u.shape[0]
    dh, dc = np.zeros((batch, n), dtype=np.float32), np.zeros((batch, n), dtype=np.float32)
    dz = np.zeros((steps, batch, 4 * n), dtype=np.float32)
    du = np.zeros_like(u)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, c, h, tc, _ = saved[t]
        m = mask[t][:, None]
        dh = dh + dout[t]
        step = m * dh
        d = m * dc + step * o * (1 - tc * tc)
        dz[t] = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), step * tc * o * (1 - o), d * i * (1 - g * g)], axis=1)
        du += h.T @ dz[t]
        dh = dz[t] @ u.T + (1 - m) * dh
        dc = d * f + (1 - m) * dc
    return np.einsum("tbd,tbz->dz", x, dz, optimize=True), du, dz.sum(axis=(0, 1))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward sequences (time, batch, DIM) and their mask."""
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), DIM), dtype=np.float32)
    y, mask = np.zeros_like(x), np.zeros((steps, len(pages)), dtype=np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j], y[:len(p), j], mask[:len(p), j] = p, p[::-1], 1
    return x, y, mask


def _turned(states: np.ndarray, lengths: list[int]) -> np.ndarray:
    """States of the backward run in page order, and back."""
    out = np.zeros_like(states)
    for j, n in enumerate(lengths):
        out[:n, j] = states[:n, j][::-1]
    return out


def _vectors(page: np.ndarray | list[Block], lo: int, hi: int) -> np.ndarray:
    return page[lo:hi] if isinstance(page, np.ndarray) else block_vectors(page, lo, hi)


def _states(pages: list, w, u, b, back: bool) -> list[np.ndarray]:
    """States of an LSTM over each page, the longest first, in page order; inputs are made STEPS blocks at a time."""
    lengths = np.array([len(p) for p in pages])
    out = [np.empty((n, u.shape[0]), dtype=np.float32) for n in lengths]
    h = c = np.zeros((len(pages), u.shape[0]), dtype=np.float32)
    for lo in range(0, lengths[0], STEPS):
        live = int((lengths > lo).sum())
        ends = np.minimum(lengths[:live], lo + STEPS)
        zx = np.zeros((ends[0] - lo, live, u.shape[1]), dtype=np.float32)
        for j, (n, hi) in enumerate(zip(lengths, ends)):
            zx[:hi - lo, j] = (_vectors(pages[j], n - hi, n - lo)[::-1] if back else _vectors(pages[j], lo, hi)) @ w + b
        states = np.zeros((ends[0] - lo, live, u.shape[0]), dtype=np.float32)
        for t in range(ends[0] - lo):
            k = int((ends > lo + t).sum())
            i, f, o, g = np.split(zx[t, :k] + h[:k] @ u, 4, axis=1)
            c = _sigmoid(f + 1) * c[:k] + _sigmoid(i) * np.tanh(g)
            h = _sigmoid(o) * np.tanh(c)
            states[t, :k] = h
        for j, (n, hi) in enumerate(zip(lengths, ends)):
            if back:
                out[j][n - hi:n - lo] = states[:hi - lo, j][::-1]
            else:
                out[j][lo:hi] = states[:hi - lo, j]
    return out


def _batches(pages: Iterable) -> Iterator[list]:
    """Pages in turn, in lists of at most BATCH blocks; a longer page is alone."""
    own, total = [], 0
    for p in pages:
        if own and total + len(p) > BATCH:
            yield own
            own, total = [], 0
        own.append(p)
        total += len(p)
    if own:
        yield own


@dataclass
class Labeller:
    weights: list[np.ndarray]  # w, u, b forward; w, u, b backward; output weights and bias

    def logits(self, pages: list[np.ndarray] | list[list[Block]]) -> list[np.ndarray]:
        """The score of every block of each page (its vectors or its blocks); above 0 is main text."""
        return [z for own in _batches(pages) for z in self._logits(own)]

    def _logits(self, pages: list) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, dtype=np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
        if not order:
            return out
        # Vectors are made once; only those of a page beyond the bound are made anew where they are needed.
        own = [pages[i] if isinstance(pages[i], np.ndarray) or len(pages[i]) > BATCH else block_vectors(pages[i]) for i in order]
        *w, v, a = self.weights
        for i, h, k in zip(order, _states(own, *w[:3], False), _states(own, *w[3:], True)):
            out[i] = h @ v[:HIDDEN] + k @ v[HIDDEN:] + a
        return out


def _gradients(w: list[np.ndarray], pages: list[np.ndarray], labels: list[np.ndarray], count) -> list[np.ndarray]:
    """Gradients of the weights, of the loss summed over the pages' blocks and divided by ``count``."""
    lengths = [len(p) for p in pages]
    x, y, mask = _padded(pages)
    fore, aft = _run(x, mask, *w[:3]), _run(y, mask, *w[3:6])
    h, k = np.stack([q[-1] for q in fore]), _turned(np.stack([q[-1] for q in aft]), lengths)
    both = np.concatenate([h, k], axis=2)
    truth = np.zeros_like(mask)
    for j, label in enumerate(labels):
        truth[:lengths[j], j] = label
    dz = ((_sigmoid(both @ w[6] + w[7]) - truth) * mask / count).astype(np.float32)
    dboth = dz[:, :, None] * w[6]
    gf = _back(x, mask, w[0], w[1], fore, dboth[:, :, :HIDDEN])
    gb = _back(y, mask, w[3], w[4], aft, _turned(dboth[:, :, HIDDEN:], lengths))
    return [*gf, *gb, np.einsum("tb,tbh->h", dz, both), dz.sum()]


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 7, rate: float = 8e-3, seed: int = 5) -> Labeller:
    """Fit the labeller by back-propagation through time with Adam."""
    rng = np.random.default_rng(seed)
    make = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
    w = [make(DIM, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32),
         make(DIM, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32),
         make(2 * HIDDEN), np.zeros((), np.float32)]
    m, s, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    keep = [i for i in range(len(pages)) if len(pages[i])]
    for _ in range(epochs):
        order = [keep[i] for i in rng.permutation(len(keep))]
        groups = [sorted(order[a:a + 16 * 8], key=lambda i: len(pages[i])) for a in range(0, len(order), 16 * 8)]
        for own in (g[a:a + 16] for g in groups for a in range(0, len(g), 16)):
            count = np.float32(sum(len(pages[i]) for i in own))
            # A batch with long pages is run in parts whose gradients are added up.
            wide = max(1, BATCH // max(len(pages[i]) for i in own))
            parts = [_gradients(w, [pages[i] for i in p], [labels[i] for i in p], count)
                     for p in (own[a:a + wide] for a in range(0, len(own), wide))]
            grads = parts[0] if len(parts) == 1 else [sum(g) for g in zip(*parts)]
            t += 1
            for q, g in enumerate(grads):
                g = np.clip(g, -1, 1)
                m[q] = 0.9 * m[q] + 0.1 * g
                s[q] = 0.999 * s[q] + 0.001 * g * g
                w[q] = (w[q] - rate * (m[q] / (1 - 0.9 ** t)) / (np.sqrt(s[q] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return Labeller(w)


class _Composer:
    """Pages in random layouts; elements of the main part carry data-y=1, others inside it data-y=0."""

    def __init__(self, texts: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.texts = texts or ["".join(self.rng.choice(list("abcdefghij   "), 200)) for _ in range(50)]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def long(self) -> str:
        words = self.pick(self.texts).split(" ")
        n = int(np.exp(self.rng.uniform(np.log(2), np.log(150))))
        at = int(self.rng.integers(max(1, len(words) - n + 1)))
        return " ".join(words[at:at + n])

    def short(self, most: int = 6) -> str:
        return " ".join(self.pick(self.texts).split(" ")[:int(self.rng.integers(1, most + 1))])

    def element(self, names, tags, inside: str, y: int | None = None) -> str:
        tag = self.pick(tags)
        kind = self.pick(("class", "class", "id"))
        name = f' {kind}="{self.pick(names)}"' if tag in ("div", "section", "ul", "ol", "p", "td", "span") or self.rng.random() < 0.3 else ""
        mark = "" if y is None else f" data-y={y}"
        return f"<{tag}{name}{mark}>{inside}</{tag}>"

    def links(self) -> str:
        items = [f'<a href="/{i}">{self.short(4)}</a>' for i in range(int(self.rng.integers(2, 9)))]
        form = self.rng.random()
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if form < 0.6 else " | ".join(items)

    def some_text(self) -> str:
        form = self.rng.random()
        if form < 0.4:
            return self.long()
        if form < 0.7:
            return f"<p>{self.long()}</p>"
        return f"<h3>{self.short()}</h3><p>{self.long()}</p><a href='#'>{self.short(3)}</a>"

    def other(self) -> str:
        kind = int(self.rng.integers(9))
        if kind == 0:
            return self.element(NOTICE_NAMES, ("div", "section", "div"), self.some_text() + f"<button>{self.short(2)}</button>", 0)
        if kind == 1:
            return self.element(HEADER_NAMES, ("header", "div"), f"<a href='/'>{self.short(3)}</a><p>{self.short()}</p>" if self.rng.random() < 0.5 else f"<h2>{self.short()}</h2>{self.links()}", 0)
        if kind == 2:
            return self.element(MENU_NAMES, ("nav", "ul", "div"), self.links(), 0)
        if kind == 3:
            return self.element(ADVERT_NAMES, ("div", "aside", "section", "p", "div"), self.long() if self.rng.random() < 0.7 else self.some_text(), 0)
        if kind == 4:
            return f"<form data-y=0><label>{self.short()}</label><input name=q><button>{self.short(2)}</button><p>{self.long()}</p></form>"
        if kind == 5:
            return self.element(SIDE_NAMES, ("aside", "div", "section"), self.some_text() if self.rng.random() < 0.5 else self.links(), 0)
        if kind == 6:
            inside = "".join(f"<div><b>{self.short(2)}</b><p>{self.long()}</p></div>" if self.rng.random() < 0.5 else f"<p>{self.long()}</p>" for _ in range(int(self.rng.integers(1, 6))))
            return self.element(COMMENT_NAMES, ("section", "div", "ol"), f"<h3>{self.short(3)}</h3>" * int(self.rng.integers(2)) + inside, 0)
        if kind == 7:
            return self.element(FOOTER_NAMES, ("footer", "footer", "div"), f"&copy; {self.short(3)} &middot; {self.long()}" if self.rng.random() < 0.6 else f"<p>{self.long()}</p>{self.links()}", 0)
        return self.element(SHARE_NAMES, ("div", "ul"), self.links() if self.rng.random() < 0.6 else self.short(), 0)

    def paragraph(self) -> str:
        form, text = self.rng.random(), self.long()
        if form < 0.5:
            return f"<p>{text}</p>"
        if form < 0.6:
            return f"<p>{text}"
        if form < 0.68:
            return f"<p><b>{text}<br><p>"
        if form < 0.75:
            return f"<p>{text} <a href='/x'>{self.short(3)}</a> {self.long()}</p>"
        if form < 0.8:
            return f"<h2>{self.short()}</h2>"
        if form < 0.86:
            return "<ul>" + "".join(f"<li>{self.short(12)}</li>" for _ in range(int(self.rng.integers(2, 6)))) + "</ul>"
        if form < 0.9:
            return f"<blockquote>{text}</blockquote>"
        if form < 0.94:
            return f"<div>{text}</div>"
        if form < 0.97:
            return "<table>" + "".join(f"<tr><td>{self.short()}</td><td>{self.short()}</td></tr>" for _ in range(3)) + "</table>"
        return f"{text}<br>"

    def page(self) -> str:
        inside = "".join(self.paragraph() for _ in range(int(self.rng.integers(1, 12))))
        if self.rng.random() < 0.3:
            cut = inside.find("</p>") + 4
            inside = inside[:cut] + self.other() + inside[cut:] if cut > 3 else inside
        if self.rng.random() < 0.75:
            inside = f"<h1>{self.short(12)}</h1>" + inside
        if self.rng.random() < 0.2:
            inside += self.other()
        main = self.element(MAIN_NAMES, ("article", "article", "article", "main", "div", "div", "section"), inside, 1)
        if self.rng.random() < 0.25:
            main = self.element(MAIN_NAMES, ("main", "div", "section"), main)
        before = "".join(self.other() for _ in range(int(self.rng.integers(0, 5))))
        after = "".join(self.other() for _ in range(int(self.rng.integers(0, 5))))
        body = before + main + after
        if self.rng.random() < 0.3:
            body = f'<div class="{self.pick(("wrapper", "page", "container", "layout", "site"))}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.short(12)}</title></head><body>{body}</body></html>"


def marked_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks its article by tag; None if it does not."""
    y = np.zeros(len(page), dtype=np.float32)
    known: dict[int, tuple[bool, bool]] = {}  # by element: inside the article, inside something else
    for i, b in enumerate(page):
        way, at = [], b.within
        while at and id(at) not in known:
            way.append(at)
            at = at.parent
        main, other = known[id(at)] if at else (False, False)
        for at in reversed(way):
            tag, *words = at.names.split(" ")
            main, other = main or tag in MAIN_TAGS, other or tag in OTHER_TAGS or not _OTHER_WORDS.isdisjoint(words)
            known[id(at)] = main, other
        y[i] = main and not other
    return y if y.any() else None


def fit_labeller(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE, composed: int = COMPOSED) -> Labeller:
    """Train on ``sample`` pages at most of the table (of at most SAMPLE_CHARS characters) and ``composed`` made-up ones."""
    rows = pages.select(F.col(html_col).alias("html")).where(F.length("html").between(1, SAMPLE_CHARS))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _fit([blocks(h, marked=False) for f in frames for h in f["html"]], composed)
        yield pd.DataFrame({"weights": [pickle.dumps(model.weights)]})

    # One task, over the bounded sample, as the training is one loop.
    drawn = rows.orderBy(F.xxhash64("html")).limit(sample).coalesce(1)
    return Labeller(pickle.loads(drawn.mapInPandas(fit, "weights binary").first()[0]))


def _fit(seen: list[list[Block]], composed: int) -> Labeller:
    texts = [b.text for p in seen for b in p if len(b.text) > 40]
    x, y = [], []
    for p in seen:
        if (label := marked_labels(p)) is not None:
            x.append(block_vectors(p))
            y.append(label)
    composer = _Composer(texts, 11)
    for _ in range(composed):
        p = blocks(composer.page())
        x.append(block_vectors(p))
        y.append(np.array([b.label for b in p], dtype=np.float32))
    return train(x, y)


def main_text(pages: list[str | None], model: Labeller) -> list[str]:
    """The blocks of each page that are main text, joined by one space."""
    return [" ".join(b.text for b, s in zip(p, z) if s > 0)
            for cut in _batches(blocks(p, marked=False) for p in pages) for p, z in zip(cut, model.logits(cut))]


def extract_text(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Null, empty and broken pages give what text the parser finds, or an
    empty text. Repeated rows give equal texts; other columns are left out;
    no shuffle.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)  # DIM * HIDDEN * 8 numbers

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 512):
                part = f.iloc[at:at + 512]
                text = main_text(part["html"].tolist(), sent.value)
                yield part[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    cols = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = cols.schema["page_id"].dataType.simpleString()
    return cols.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")
