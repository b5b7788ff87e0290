"""Word shingles of whole texts as sorted 64-bit hashes, by numpy over the text's bytes.

Words are runs of characters other than the six ASCII white-space
characters, A-Z lower-cased. A word's hash is a polynomial in its bytes
taken from prefix sums, so there is no loop over words; a shingle's hash
mixes the hashes of its words by place. Long texts are hashed in chunks cut
at white space.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
CHUNK = 1 << 20
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.default_rng(20).integers(1 << 62, 1 << 63, 256, dtype=np.uint64) | U(1)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


# Odd factors of the words of a shingle by their place.
_PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | U(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 14), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= CHUNK:
            _POWERS[int(base)] = have
    return have[:n]


def _chunk_hashes(b: np.ndarray) -> np.ndarray:
    space = np.ones(len(b) + 2, dtype=bool)
    space[1:-1] = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    terms = _VALUE[_LOWER[b]] * _powers(BASE, len(b))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * _powers(INVERSE, len(b))[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word in turn; none for null."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= CHUNK:
        return _chunk_hashes(np.frombuffer(data, dtype=np.uint8))
    out, at = [], 0
    b = np.frombuffer(data, dtype=np.uint8)
    while at < len(b):
        end = min(at + CHUNK, len(b))
        while end < len(b) and not _SPACE[b[end]]:
            more = np.flatnonzero(_SPACE[b[end:end + CHUNK]])
            end = end + int(more[0]) if len(more) else min(end + CHUNK, len(b))
        out.append(_chunk_hashes(b[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(size, len(w))
    total = w[:len(w) - n + 1] * _PLACES[0] + U(n)
    for j in range(1, n):
        total += w[j:j + len(total)] * _PLACES[j % len(_PLACES)]
    return np.unique(mix(total))
