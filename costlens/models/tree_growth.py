"""Growing regression trees on binned features: split choice, subtrees in one task, exact leaf quantiles.

All sums are of weights, so with whole-number weights they are exact and a
tree does not hang on how its rows were partitioned or on where a node was
grown. Nodes are numbered from the root: node i has children 2i and 2i + 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

DIGIT_BITS = 16  # of a residual's 64 sorted bits that one pass of the distributed leaf quantile fixes


@dataclass(frozen=True)
class Spec:
    """Settings of one boosted model of a batch.

    ``loss`` is ``quantile`` (pinball loss at ``alpha``) or ``squared``.
    ``group`` names the rows that the model is about (None: all) and ``fold``
    those of them that it does not learn from (None: none). ``features`` are the
    numbers of the features that it may use (None: all), ``node_features`` is
    how many of them a split chooses from (None: all), drawn by a hash of seed,
    round and node. With whole-number weights the sums of the quantile loss are
    exact; those of the squared loss are of residuals, so equal gains may fall
    otherwise on another partitioning.
    """

    alpha: float = 0.5
    n_estimators: int = 100
    max_depth: int = 3
    min_samples_leaf: int = 1
    min_samples_split: int = 2
    learning_rate: float = 0.1
    fold: int | None = None
    node_features: int | None = None
    seed: int = 42
    loss: str = "quantile"
    group: int | None = None
    features: tuple | None = None

    def gradient(self, res: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What a split compares: weight above the prediction, or weighted residual."""
        return np.where(res > 0, w, 0.0) if self.loss == "quantile" else w * res


@dataclass
class Tree:
    """Node arrays; ``left < 0`` marks a leaf. ``cut`` is the last bin that goes left, ``key`` the node's number from the root."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    count: np.ndarray
    key: np.ndarray

    FIELDS = (("feature", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32), ("value", np.float64),
              ("gain", np.float64), ("count", np.float64), ("key", np.int64))

    @classmethod
    def root(cls, count: float) -> Tree:
        return cls(*[np.array([x], dtype=d) for x, (_, d) in zip((-1, -1, -1, -1, 0.0, 0.0, count, 1), cls.FIELDS)])

    def nodes_of(self, x: np.ndarray) -> np.ndarray:
        """Index of the node that each row of bins ends in."""
        leaf = self.left < 0  # a row that is in a leaf stays there
        step = np.where(leaf, np.arange(len(leaf)), self.left).astype(np.int32)
        feature, cut = np.where(leaf, 0, self.feature), np.where(leaf, np.iinfo(np.int32).max, self.cut)
        at, flat = np.zeros(len(x), dtype=np.int32), np.ascontiguousarray(x).ravel()
        base = np.arange(len(x)) * x.shape[1]
        for _ in range(int(self.key.max()).bit_length() - int(self.key[0]).bit_length()):
            at = step[at] + (flat[base + feature[at]] > cut[at])
        return at

    def split(self, node: int, feature: int, cut: int, gain: float, left: float, right: float) -> tuple[int, int]:
        """Give a leaf two children with these counts; returns their indices."""
        n = len(self.left)
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = n, n + 1
        for name, kind in self.FIELDS:
            new = {"count": (left, right), "key": (2 * self.key[node], 2 * self.key[node] + 1)}.get(
                name, (0, 0) if name in ("value", "gain") else (-1, -1))
            setattr(self, name, np.concatenate([getattr(self, name), np.array(new, dtype=kind)]))
        return n, n + 1

    def split_all(self, nodes: np.ndarray, splits: Splits) -> np.ndarray:
        """``split`` of several leaves, one after the other; returns the left children, each followed by the right one."""
        first = len(self.left) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.gain[nodes] = splits.feature, splits.cut, splits.gain
        self.left[nodes], self.right[nodes] = first, first + 1
        both = {"count": (splits.left, splits.right), "key": (2 * self.key[nodes], 2 * self.key[nodes] + 1)}
        for name, kind in self.FIELDS:
            new = np.full((len(nodes), 2), 0 if name in ("value", "gain") else -1, dtype=kind)
            if name in both:
                new[:, 0], new[:, 1] = both[name]
            setattr(self, name, np.concatenate([getattr(self, name), new.ravel()]))
        return first

    def graft(self, node: int, sub: Tree) -> None:
        """Put a subtree in a leaf's place."""
        base = len(self.left) - 1  # the subtree's node i (from 1) comes at base + i
        for name, kind in self.FIELDS:
            values = getattr(sub, name).copy()
            if name in ("left", "right"):
                values = np.where(values >= 0, values + base, values).astype(kind)
            mine = getattr(self, name)
            mine[node] = values[0]
            setattr(self, name, np.concatenate([mine, values[1:]]))

    def to_bytes(self) -> bytes:
        return b"".join(getattr(self, n).astype(k).tobytes() for n, k in self.FIELDS)

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        size = sum(np.dtype(k).itemsize for _, k in cls.FIELDS)
        n, at, out = len(data) // size, 0, []
        for _, k in cls.FIELDS:
            out.append(np.frombuffer(data, dtype=k, count=n, offset=at).copy())
            at += n * np.dtype(k).itemsize
        return cls(*out)


def _hash(a: np.ndarray) -> np.ndarray:
    """Mixed 64-bit values (the finaliser of splitmix64)."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def feature_order(spec: Spec, round_: int, keys: np.ndarray, n_features: int) -> np.ndarray:
    """Per node the features in the order in which the node draws them."""
    seed = np.uint64((spec.seed * 0x9E3779B9 + round_ * 0x85EBCA6B + 1) % (1 << 64))
    h = _hash(_hash(keys.astype(np.uint64)[:, None] + seed) + np.arange(n_features, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D))
    return np.argsort(h, axis=1, kind="stable")


@dataclass
class Splits:
    feature: np.ndarray  # -1: the node stays a leaf
    cut: np.ndarray
    gain: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def of(self, nodes: np.ndarray) -> Splits:
        return Splits(*(getattr(self, c)[nodes] for c in ("feature", "cut", "gain", "left", "right")))


def best_splits(n: np.ndarray, w: np.ndarray, p: np.ndarray, bins: list[int], spec: Spec, round_: int, keys: np.ndarray) -> Splits:
    """The split of each node with the largest fall of the squared error of the gradient.

    ``n``, ``w`` and ``p`` are (node, bin) tables, the features' bins one after
    the other: rows, their weight, and their summed gradient. Ties go to the first feature and the lowest cut. A node
    that is too small, or in which no cut gains, gets feature -1.
    """
    nodes, f = len(n), len(bins)
    feature, cut = np.full(nodes, -1), np.full(nodes, -1)
    gain, left, right = np.zeros(nodes), np.zeros(nodes), np.zeros(nodes)
    per = np.full((nodes, f), -1.0)
    best_cut = np.zeros((nodes, f), dtype=int)
    best_left = np.zeros((nodes, f))
    varies = np.zeros((nodes, f), dtype=bool)
    total_n = n[:, :bins[0]].sum(axis=1)
    total_w, total_p = w[:, :bins[0]].sum(axis=1)[:, None], p[:, :bins[0]].sum(axis=1)[:, None]
    least = max(1, spec.min_samples_leaf)

    def gains(nl: np.ndarray, wl: np.ndarray, pl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gain of each cut with these sums on its left, and whether it parts the rows."""
        wr, pr, nr = total_w - wl, total_p - pl, total_n[:, None] - nl
        ok = (nl >= least) & (nr >= least) & (wl > 0) & (wr > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(ok, (pl * wr - pr * wl) ** 2 / (wl * wr * total_w), -1.0), (nl > 0) & (nr > 0)

    rows = np.arange(nodes)
    first_bin = np.cumsum([0, *bins])
    used = [j for j, b in enumerate(bins) if b > 1 and (spec.features is None or j in spec.features)]
    two = [j for j in used if bins[j] == 2]
    if two:  # features of one cut, all at once
        cells = first_bin[two]
        per[:, two], varies[:, two] = gains(n[:, cells], w[:, cells], p[:, cells])
        best_left[:, two] = n[:, cells]
    for j in used:
        if bins[j] > 2:
            part = slice(first_bin[j], first_bin[j + 1] - 1)
            nl = np.cumsum(n[:, part], axis=1)
            g, parts = gains(nl, np.cumsum(w[:, part], axis=1), np.cumsum(p[:, part], axis=1))
            c = g.argmax(axis=1)
            per[:, j], best_cut[:, j], best_left[:, j], varies[:, j] = g[rows, c], c, nl[rows, c], parts.any(axis=1)
    if spec.node_features and spec.node_features < f:
        order = feature_order(spec, round_, keys, f)
        rows = np.arange(nodes)[:, None]
        drawn = np.cumsum(varies[rows, order], axis=1) <= spec.node_features
        useful = per[rows, order] > 0
        # If none of the drawn features can be cut, the first that can, as drawing goes on.
        first = np.arange(f)[None, :] == useful.argmax(axis=1)[:, None]
        allowed = np.where((drawn & useful).any(axis=1)[:, None], drawn, first)
        mask = np.zeros_like(varies)
        mask[rows, order] = allowed
        per = np.where(mask, per, -1.0)
    j = per.argmax(axis=1)
    rows = np.arange(nodes)
    take = (per[rows, j] > 0) & (total_n >= max(2, spec.min_samples_split))
    feature[take], cut[take] = j[take], best_cut[rows, j][take]
    gain[take], left[take] = per[rows, j][take], best_left[rows, j][take]
    right[take] = total_n[take] - left[take]
    return Splits(feature, cut, gain, left, right)


def lower_quantile(order_sums: np.ndarray, alpha: float, total: float) -> int:
    """Index of the first running sum that reaches the share ``alpha`` of the total."""
    return min(int(np.searchsorted(order_sums, alpha * total - 1e-9 * total, side="left")), len(order_sums) - 1)


def grow_subtree(x: np.ndarray, res: np.ndarray, w: np.ndarray, bins: list[int], spec: Spec, round_: int, key: int = 1,
                 depth: int = 0) -> Tree:
    """The subtree under node ``key`` at ``depth`` over its rows, with leaf values: exact quantiles (or means) of the residuals."""
    return subtree_and_leaves(x, res, w, bins, spec, round_, key, depth)[0]


def subtree_and_leaves(x: np.ndarray, res: np.ndarray, w: np.ndarray, bins: list[int], spec: Spec, round_: int, key: int = 1,
                       depth: int = 0) -> tuple[Tree, np.ndarray]:
    """``grow_subtree`` and the leaf of each row."""
    tree = Tree.root(float(len(x)))
    tree.key[0] = key
    offset = np.concatenate([[0], np.cumsum(bins)])
    width = int(offset[-1])
    up = spec.gradient(res, w)
    unit = bool((w == 1).all())
    leaf_of = np.zeros(len(x), dtype=np.int64)
    level = np.array([0])
    rows, node, xs, ups, ws = np.arange(len(x)), leaf_of, np.ascontiguousarray(x.T), up, w
    for _ in range(depth, spec.max_depth):
        big = tree.count[level] >= max(2, spec.min_samples_split, 2 * spec.min_samples_leaf)
        level = level[big]
        if not len(level):
            break
        spot = np.full(len(tree.left), -1)
        spot[level] = np.arange(len(level))
        node = spot[leaf_of[rows]]
        if (node < 0).any():
            kept = node >= 0
            rows, node = rows[kept], node[kept]
        if len(rows) < len(x):
            xs, ups, ws = np.ascontiguousarray(x[rows].T), up[rows], w[rows]
        n, wt, p = (np.zeros((len(level), width)) for _ in range(3))
        for j, b in enumerate(bins):
            if b < 2 and j:
                continue  # no cut; the totals are those of the first feature
            cell = node * b + xs[j]
            part = slice(offset[j], offset[j] + b)
            n[:, part] = np.bincount(cell, minlength=len(level) * b).reshape(-1, b)
            p[:, part] = np.bincount(cell, weights=ups, minlength=len(level) * b).reshape(-1, b)
            wt[:, part] = n[:, part] if unit else np.bincount(cell, weights=ws, minlength=len(level) * b).reshape(-1, b)
        s = best_splits(n, wt, p, bins, spec, round_, tree.key[level])
        cuts = np.flatnonzero(s.feature >= 0)
        first = tree.split_all(level[cuts], s.of(cuts))
        left = np.full(len(level), -1)
        left[cuts] = first
        moved = np.flatnonzero(left[node] >= 0)
        nd = node[moved]
        rows = rows[moved]
        leaf_of[rows] = left[nd] + (xs[s.feature[nd], moved] > s.cut[nd])
        level = np.stack([first, first + 1], axis=1).ravel()
    # By leaf, then by residual. The order of equal residuals shows only in sums of different weights.
    by = np.argsort(res) if unit else np.argsort(res, kind="stable")
    of = leaf_of[by]
    by = by[np.argsort(of.astype(np.int16) if len(tree.left) < 1 << 15 else of, kind="stable")]
    ends = np.cumsum(np.bincount(leaf_of, minlength=len(tree.left)))
    v, vw = res[by], w[by]
    weighted = vw * v if spec.loss == "squared" else None
    for leaf in np.flatnonzero(tree.left < 0):
        part = slice(ends[leaf - 1] if leaf else 0, ends[leaf])
        size = part.stop - part.start
        if not size:
            continue
        if spec.loss == "squared":
            tree.value[leaf] = weighted[part].sum() / max(float(size) if unit else vw[part].sum(), 1e-300)
            continue
        sums = np.cumsum(vw[part])
        tree.value[leaf] = v[part][lower_quantile(sums, spec.alpha, sums[-1])]
    return tree, leaf_of


# Values from which a quantile is looked for inside a bracket that a sample gives, and the sample's size.
BRACKET, BRACKET_SAMPLE = 8192, 1024


def quantile_of(v: np.ndarray, alpha: float, w: np.ndarray | None = None) -> float:
    """The first value, in order, at which the running weight reaches the share ``alpha`` (``w`` None: all weigh 1).

    Of many values only those between two values of a sample are sorted, with
    the weight under them known; if the quantile is not there, all are. Weights
    are whole numbers, so the sums, and the value, are the same either way.
    """
    total = float(len(v)) if w is None else float(w.sum())
    below = 0.0
    if len(v) >= BRACKET:
        sample = np.sort(v[::len(v) // BRACKET_SAMPLE])
        near, off = alpha * len(sample), 5 * math.sqrt(alpha * (1 - alpha) * len(sample)) + 2
        low, high = int(near - off), int(near + off)
        keep = np.ones(len(v), dtype=bool) if low < 0 else v >= sample[low]
        under = float(np.count_nonzero(~keep)) if w is None else float(w[~keep].sum())
        if high < len(sample):
            keep &= v <= sample[high]
        some, weights = v[keep], None if w is None else w[keep]
        inside = float(len(some)) if w is None else float(weights.sum())
        if under < alpha * total - 1e-9 * total <= under + inside:
            v, w, below = some, weights, under
    if w is None:
        want = int(np.searchsorted(np.arange(1, len(v) + 1) + below, alpha * total - 1e-9 * total, side="left"))
        want = min(want, len(v) - 1)
        return float(np.partition(v, want)[want])
    by = np.argsort(v)
    return float(v[by[lower_quantile(below + np.cumsum(w[by]), alpha, total)]])


# Leaves of fewer rows than this, on average, have their quantiles found together.
MANY_LEAVES = 512


def place_of(size: np.ndarray, alpha: float, weight: float) -> np.ndarray:
    """``lower_quantile`` of leaves of so many rows that all have the same weight."""
    total = size * weight
    want = alpha * total - 1e-9 * total
    i = np.ceil(want / weight).astype(np.int64) - 1
    i = np.where(i * weight >= want, i - 1, i)  # the division may be off by one step
    i = np.where((i + 1) * weight < want, i + 1, i)
    return np.clip(i, 0, size - 1)


# Rows from which a node's rows are kept, counted and parted by themselves.
MANY_ROWS = 4096
# Joint values of several features that are counted as one, at most, and different weights that are counted apart.
JOINT, WEIGHTS = 512, 4


class Growth:
    """The rows of one model, for many trees: the trees of ``grow_subtree`` from the root, with fewer passes over the rows.

    With at most ``WEIGHTS`` whole-number weights and the quantile loss a row
    is a count: features of few joint values are counted together and told
    apart afterwards, and rows, weight and gradient come from one count. Those
    sums are exact, so the trees are the same. Other rows take the general way.
    """

    def __init__(self, x: np.ndarray, w: np.ndarray, bins: list[int], spec: Spec):
        self.x, self.w, self.bins, self.spec = x, w, bins, spec
        self.offset = np.concatenate([[0], np.cumsum(bins)])
        kinds = np.unique(w)
        self.counts = spec.loss == "quantile" and len(kinds) <= WEIGHTS and bool((kinds == np.floor(kinds)).all())
        if not self.counts:
            return
        self.kinds, self.kind = kinds, np.searchsorted(kinds, w).astype(np.int32)
        self.flat = np.ascontiguousarray(x).ravel()
        self.cols = [np.ascontiguousarray(x[:, j]) for j in range(len(bins))]
        self.joint = []  # (features, code of each row, bin of each feature in each code, cells and which codes each one has)
        some: list[int] = []
        code, at = np.zeros(len(x), dtype=np.int32), np.zeros((0, 1), dtype=np.int64)

        def close() -> None:
            if len(some) > 1:
                cells = np.concatenate([np.arange(self.offset[j], self.offset[j + 1]) for j in some])
                one = np.concatenate([np.arange(bins[j])[:, None] == of for j, of in zip(some, at)]).astype(np.float64)
                self.joint.append((list(some), code, at, cells, one))

        for j in np.argsort(bins, kind="stable"):
            for again in (False, True):
                both = code * np.int32(bins[j]) + self.cols[j]
                seen = np.flatnonzero(np.bincount(both, minlength=at.shape[1] * bins[j]))
                if len(seen) <= JOINT or again:
                    break
                close()
                some, code, at = [], np.zeros(len(x), dtype=np.int32), np.zeros((0, 1), dtype=np.int64)
            at = np.concatenate([at[:, seen // bins[j]], (seen % bins[j])[None, :]])
            back = np.zeros(int(seen[-1]) + 1 if len(seen) else 1, dtype=np.int32)
            back[seen] = np.arange(len(seen))
            some, code = [*some, int(j)], back[both]
        close()

    def _cells(self, rows, node: np.ndarray, state: np.ndarray, nodes: int):
        """(rows, weight, gradient) by (node, bin), the features' bins one after the other."""
        states, width = 2 * len(self.kinds), int(self.offset[-1])
        base = state if nodes == 1 else node * states + state
        n, w, p = (np.zeros((nodes, width)) for _ in range(3))

        def counted(code: np.ndarray, k: int) -> np.ndarray:
            at = code if rows is None else code[rows]
            got = np.bincount(at * (np.int32 if k * nodes * states < 1 << 31 else np.int64)(nodes * states) + base,
                              minlength=k * nodes * states)
            return got.reshape(k, nodes, len(self.kinds), 2).astype(np.float64)

        def put(cells, got: np.ndarray) -> None:
            n[:, cells] = got.sum(axis=(2, 3)).T
            w[:, cells] = (got.sum(axis=3) @ self.kinds).T
            p[:, cells] = (got[..., 1] @ self.kinds).T

        done = set()
        for features, code, at, cells, one in self.joint:
            if nodes * at.shape[1] * 4 > len(base) * len(features):
                continue  # few rows a cell: cheaper feature by feature
            got = counted(code, at.shape[1])
            put(cells, (one @ got.reshape(at.shape[1], -1)).reshape(len(cells), *got.shape[1:]))
            done.update(features)
        for j, b in enumerate(self.bins):
            if j not in done:
                put(slice(self.offset[j], self.offset[j + 1]), counted(self.cols[j], b))
        return n, w, p

    def tree(self, res: np.ndarray, round_: int) -> tuple[Tree, np.ndarray]:
        """The tree of these residuals and the leaf of each row."""
        spec = self.spec
        if not self.counts:
            return subtree_and_leaves(self.x, res, self.w, self.bins, spec, round_)
        tree = Tree.root(float(len(res)))
        state = 2 * self.kind + (res > 0)
        leaf_of = np.zeros(len(res), dtype=np.int32)
        least = max(2, spec.min_samples_split, 2 * spec.min_samples_leaf)
        width = self.x.shape[1]
        # The rows of each node of many rows (None: all); those of the other nodes together, with their nodes.
        own = {0: None} if len(res) >= MANY_ROWS else {}
        rows = np.arange(0 if own else len(res))
        place = np.zeros(len(rows), dtype=np.int32)
        ended = []  # rows of the latter that are in leaves
        level = np.array([0])
        pairs = hist = None  # the left children of the nodes split last, and those nodes' cells
        for _ in range(spec.max_depth):
            if pairs is not None:
                used = np.maximum(tree.count[pairs], tree.count[pairs + 1]) >= least
                pairs, hist = pairs[used], [h[used] for h in hist]
                level = np.stack([pairs, pairs + 1], axis=1).ravel()
            level = level[tree.count[level] >= least]
            if not len(level):
                break
            if pairs is None:
                hist = self._cells(None, leaf_of, state, 1)
            else:
                # Only the child of fewer rows is counted; the other has what is left of their parent's (whole numbers).
                less = pairs + (tree.count[pairs] > tree.count[pairs + 1])
                counted = self._tables(less, own, rows, place, state, len(tree.left))
                pair = np.searchsorted(pairs, level, side="right") - 1
                mine = (less[pair] == level)[:, None]
                hist = [np.where(mine, c[pair], h[pair] - c[pair]) for c, h in zip(counted, hist)]
            s = best_splits(*hist, self.bins, spec, round_, tree.key[level])
            cuts = np.flatnonzero(s.feature >= 0)
            pairs, hist = tree.split_all(level[cuts], s.of(cuts)), [h[cuts] for h in hist]
            if len(rows):
                left = tree.left[place]
                moved = left >= 0
                if not moved.all():
                    ended.append(rows[~moved])
                    leaf_of[ended[-1]] = place[~moved]
                    rows, place, left = rows[moved], place[moved], left[moved]
                place = left + (self.flat[rows * width + tree.feature[place]] > tree.cut.astype(np.uint8)[place])
            for node in level[cuts]:
                if node not in own:
                    continue
                of, column = own.pop(node), self.cols[tree.feature[node]]
                right = (column if of is None else column[of]) > tree.cut[node]
                for child, side in ((tree.left[node], ~right), (tree.right[node], right)):
                    part = np.flatnonzero(side) if of is None else of[side]
                    if len(part) >= MANY_ROWS:
                        own[child] = part
                    else:
                        rows, place = np.concatenate([rows, part]), np.concatenate([place, np.full(len(part), child, dtype=np.int32)])
        leaf_of[rows] = place
        for node, of in own.items():
            at = slice(None) if of is None else of
            leaf_of[at] = node
            tree.value[node] = quantile_of(res[at], spec.alpha, None if len(self.kinds) == 1 else self.w[at])
        self._values(tree, np.concatenate([*ended, rows]), res, leaf_of)
        return tree, leaf_of

    def _tables(self, nodes: np.ndarray, own: dict, rows: np.ndarray, place: np.ndarray, state: np.ndarray, size: int):
        """The cells of these nodes: of each with rows of its own, and of the others together."""
        out = [np.zeros((len(nodes), int(self.offset[-1]))) for _ in range(3)]
        apart = np.array([node in own for node in nodes], dtype=bool)
        for i in np.flatnonzero(apart):
            of = own[nodes[i]]
            for table, got in zip(out, self._cells(of, None, state[of], 1)):
                table[i] = got[0]
        rest = np.flatnonzero(~apart)
        if len(rest):
            spot = np.full(size, -1, dtype=np.int32)
            spot[nodes[rest]] = np.arange(len(rest))
            node = spot[place]
            kept = np.flatnonzero(node >= 0)
            few = rows[kept]
            for table, got in zip(out, self._cells(few, node[kept], state[few], len(rest))):
                table[rest] = got
        return out

    def _values(self, tree: Tree, rows: np.ndarray, res: np.ndarray, leaf_of: np.ndarray) -> None:
        """Set the values of the leaves that these rows, all of their leaves', end in."""
        if not len(rows):
            return
        res, place, one = res[rows], leaf_of[rows], len(self.kinds) == 1
        small = np.int16 if len(tree.left) < 1 << 15 else np.int64
        size = np.bincount(place, minlength=len(tree.left))
        ends = np.cumsum(size)
        leaves = np.flatnonzero(size)
        if one and len(leaves) * MANY_LEAVES > len(rows):
            by = np.argsort(res)
            by = by[np.argsort(place[by].astype(small), kind="stable")]
            tree.value[leaves] = res[by[ends[leaves] - size[leaves] + place_of(size[leaves], self.spec.alpha, self.kinds[0])]]
            return
        order = np.argsort(place.astype(small), kind="stable")
        for leaf in leaves:
            part = order[ends[leaf] - size[leaf]:ends[leaf]]
            tree.value[leaf] = quantile_of(res[part], self.spec.alpha, None if one else self.w[rows[part]])


def grow_rounds(x: np.ndarray, y: np.ndarray, pred: np.ndarray, w: np.ndarray, bins: list[int], spec: Spec, first: int,
                end: int) -> list[Tree]:
    """The trees of the rounds ``first`` to ``end`` - 1 of a model that has these rows and predictions."""
    growth, pred, out = Growth(x, w, bins, spec), pred.copy(), []
    for round_ in range(first, end):
        tree, leaf_of = growth.tree(y - pred, round_)
        pred += spec.learning_rate * tree.value[leaf_of]
        out.append(tree)
    return out


def sortable(v: np.ndarray) -> np.ndarray:
    """64-bit whole numbers in the order of the numbers (minus zero counts as zero)."""
    bits = (v + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def from_sortable(bits: int) -> float:
    one = np.uint64(bits)
    raw = one ^ np.uint64(1 << 63) if one >> np.uint64(63) else ~one
    return float(np.array([raw], dtype=np.uint64).view(np.float64)[0])


@dataclass
class BigLeaf:
    """A leaf of more rows than one task takes: the leading bits of its quantile found so far."""

    prefix: int = 0
    bits: int = 0
    below: float = 0.0  # weight under the prefix
    total: float | None = None
    done: bool = field(default=False)

    def cells(self, res: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digit and weight of the residuals that share the prefix."""
        s = sortable(res)
        if self.bits:
            inside = s >> np.uint64(64 - self.bits) == np.uint64(self.prefix)
            s, w = s[inside], w[inside]
        digit = (s >> np.uint64(64 - self.bits - DIGIT_BITS)) & np.uint64((1 << DIGIT_BITS) - 1)
        return digit.astype(np.int64), w

    def choose(self, digit: np.ndarray, weight: np.ndarray, alpha: float) -> None:
        """Fix the next digit from the weights of the digits (ascending)."""
        sums = self.below + np.cumsum(weight)
        if self.total is None:
            self.total = float(sums[-1])
        i = lower_quantile(sums, alpha, self.total)
        self.below = float(sums[i] - weight[i])
        self.prefix = (self.prefix << DIGIT_BITS) | int(digit[i])
        self.bits += DIGIT_BITS
        self.done = self.bits == 64

    @property
    def value(self) -> float:
        return from_sortable(self.prefix)
