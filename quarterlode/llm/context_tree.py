"""Context-tree weighting over bytes.

A byte is eight binary decisions. Each decision, given the bits before it, has a tree of
contexts: the last 0, 1, ... ``DEPTH`` bytes. Every node keeps a Krichevsky-Trofimov
estimate of its zeros and ones, and its weighted probability is half its own estimate
and half the product of its children's. What comes next is then predicted by mixing the
estimates along the path of contexts, deeper ones with the weight that the shallower
leave; a context that was never seen predicts one half. An end byte that no UTF-8 text
has closes every text, and as many of it stand before the first byte as contexts reach.

A *gram* is a number: the context, most recent byte first, then the byte itself. Sorted
grams have every context of every depth in one piece, so nodes are runs.
"""

from __future__ import annotations

import numpy as np

DEPTH = 5
EDGE = b"\xff"
LN_HALF = np.log(0.5)


def grams(texts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all bytes of pieces (``DEPTH`` bytes before, bytes), and the piece of each."""
    lengths = np.array([len(t) for _, t in texts], np.int64)
    a = np.frombuffer(b"".join(c + t for c, t in texts), np.uint8).astype(np.int64)
    piece = np.repeat(np.arange(len(texts)), lengths)
    # the r-th byte of all pieces has (piece + 1) contexts before it in the buffer
    at = np.arange(len(piece)) + (piece + 1) * DEPTH
    key = a[at]
    for j in range(1, DEPTH + 1):
        key |= a[at - j] << (8 * (DEPTH - j + 1))
    return key, piece


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series above 8, and the recurrence below."""
    shift = np.zeros_like(x)
    y = x + 8
    for i in range(8):
        shift += np.log(x + i)
    s = 1 / (y * y)
    series = (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    z, o = zeros.astype(float), ones.astype(float)
    return log_gamma(z + 0.5) + log_gamma(o + 0.5) - np.log(np.pi) - log_gamma(z + o + 1)


def _weigh(zeros, ones, below):
    """Weight of the own estimate, and logarithm of the weighted probability."""
    own = log_kt(zeros, ones)
    return 1 / (1 + np.exp(np.minimum(below - own, 700.0))), LN_HALF + np.logaddexp(own, below)


def _estimate(zeros, ones, bit):
    return (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def _node(keys: np.ndarray, i: int) -> np.ndarray:
    """Node of bit ``i``: the context, and the bits before behind a leading one."""
    return (keys >> 8 << 8) | (1 << i) | ((keys & 255) >> (8 - i))


class Subtrees:
    """All nodes below some contexts of ``top`` bytes, from the sorted distinct grams with counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, top: int):
        self.top = top
        self.levels: dict[int, list[tuple[np.ndarray, ...]]] = {}
        above: list[tuple[np.ndarray, np.ndarray]] | None = None
        for depth in range(DEPTH, top - 1, -1):
            level, passed = [], []
            for i in range(8):
                node = _node(keys, i)
                first = np.flatnonzero(np.diff(node, prepend=-1)) if len(node) else np.empty(0, np.int64)
                ones = np.add.reduceat(counts * ((keys >> (7 - i)) & 1), first) if len(first) else np.empty(0, np.int64)
                zeros = (np.add.reduceat(counts, first) if len(first) else np.empty(0, np.int64)) - ones
                name = node[first]
                if above is None:
                    weight, weighted = np.ones(len(name)), log_kt(zeros, ones)
                else:
                    child, sums = above[i]
                    at = np.searchsorted(name, (child >> 16 << 8) | (child & 255))
                    weight, weighted = _weigh(zeros, ones, np.bincount(at, sums, len(name)))
                level.append((name, zeros, ones, weight, weighted))
                passed.append((name, weighted))
            self.levels[depth], above = level, passed
            keys, back = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
            counts = np.bincount(back, counts, len(keys)).astype(np.int64)

    def tops(self) -> tuple[np.ndarray, ...]:
        """Nodes one depth above, with what their children here add up to: zeros, ones, log probability."""
        name, zeros, ones, _, weighted = (np.concatenate(x) for x in zip(*self.levels[self.top], strict=True))
        above, back = np.unique((name >> 16 << 8) | (name & 255), return_inverse=True)
        return above, *(np.bincount(back, x, len(above)) for x in (zeros, ones, weighted))

    def predict(self, grams_: np.ndarray, i: int) -> np.ndarray:
        """Probability of bit ``i`` of each gram, given contexts of ``top`` bytes and more."""
        p = np.full(len(grams_), 0.5)
        for depth in range(DEPTH, self.top - 1, -1):
            keys = (grams_ >> (8 * (DEPTH - depth) + 8) << 8) | (grams_ & 255)
            name, zeros, ones, weight, _ = self.levels[depth][i]
            if not len(name):
                p[:] = 0.5
                continue
            node = _node(keys, i)
            at = np.minimum(np.searchsorted(name, node), len(name) - 1)
            own = _estimate(zeros[at], ones[at], (keys >> (7 - i)) & 1)
            p = np.where(name[at] == node, weight[at] * own + (1 - weight[at]) * p, 0.5)
        return p


class Roots:
    """The nodes of depth 1 and 0, at most 65,536: from what the nodes of depth 2 add up to."""

    def __init__(self, name: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        self.zeros, self.ones, self.weight = [], [], []
        for size in (1 << 16, 1 << 8):
            z, o, b = (np.bincount(name, x, size) for x in (zeros, ones, below))
            weight, weighted = _weigh(z, o, b)
            self.zeros.append(z)
            self.ones.append(o)
            self.weight.append(weight)
            seen = np.flatnonzero(z + o)
            name, zeros, ones, below = seen & 255, z[seen], o[seen], weighted[seen]

    def predict(self, grams_: np.ndarray, i: int, p: np.ndarray) -> np.ndarray:
        bit = (grams_ >> (7 - i)) & 1
        path = (1 << i) | ((grams_ & 255) >> (8 - i))
        for level, node in enumerate(((grams_ >> (8 * DEPTH) << 8) | path, path)):
            z, o, weight = self.zeros[level][node], self.ones[level][node], self.weight[level][node]
            p = np.where(z + o > 0, weight * _estimate(z, o, bit) + (1 - weight) * p, 0.5)
        return p


def log10_probability(grams_: np.ndarray, trees: Subtrees, roots: Roots) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    total = np.zeros(len(grams_))
    for i in range(8):
        total += np.log10(roots.predict(grams_, i, trees.predict(grams_, i)))
    return total
