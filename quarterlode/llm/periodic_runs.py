"""Periodic runs of words, found by convolution of blocks.

A run is a stretch that repeats with its smallest period ``q`` at least three times over at
least 24 words, and that no neighbouring word continues. At the dyadic scale ``B`` a text is
cut into blocks that begin at multiples of ``B``; every run of a period from ``B`` to
``2B - 1`` (at the least scale from 1) is long enough to hold such a block and its copy one
period on. The sum of squared differences between a block and each place of the window that
follows it is ``sum a^2 + sum b^2 - 2 sum ab``, whose last term is a correlation: a number
theoretic transform gives it exactly modulo a prime. Equal words always give zero; a zero by
chance is refuted when the words are compared. Each zero is a distance, extended to both
sides as far as the words agree.

Distances go up, so the smallest period of a run is met first; a later zero inside a known
run at a multiple of its period is the same run again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from quarterlode.llm.common import pieces, texts

PRIME, GENERATOR = 7 * 2**20 + 1, 3  # sums of 32 products of residues stay below 2**53
RADIX = 32
LEAST = 8  # words of the smallest blocks
LARGEST = 4096  # words of the largest blocks; at larger scales a block's first words stand for it
MIN_LENGTH, MIN_REPEATS = 24, 3
ROW_WORDS = 1 << 16  # words transformed at once
GROUP_WORDS = 1 << 19  # words of texts searched together


def _reduce(x: np.ndarray) -> np.ndarray:
    """Residues about zero, in place; exact below 2**53."""
    x -= np.rint(x * (1 / PRIME)) * PRIME
    return x


@lru_cache(maxsize=64)
def _powers(rows: int, columns: int, order: int, inverse: bool) -> np.ndarray:
    """``w ** (i * j)`` for a root ``w`` of unity of the given order."""
    root = pow(GENERATOR, (PRIME - 1) // order, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    one = np.ones(order, np.int64)
    for i in range(1, order):
        one[i] = one[i - 1] * root % PRIME
    return _reduce(one[np.outer(np.arange(rows), np.arange(columns)) % order].astype(np.float64))


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number theoretic transform of each row, without the inverse's factor."""
    rows, n = x.shape
    if n <= RADIX:
        return _reduce(x @ _powers(n, n, n, inverse))
    rest = n // RADIX
    inner = _reduce(np.matmul(_powers(RADIX, RADIX, RADIX, inverse), x.reshape(rows, RADIX, rest)))
    inner = _reduce(inner * _powers(RADIX, rest, n, inverse))
    outer = transform(inner.reshape(rows * RADIX, rest), inverse)
    return outer.reshape(rows, RADIX, rest).swapaxes(1, 2).reshape(rows, n)


def mismatches(blocks: np.ndarray, windows: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Squared differences, modulo the prime, of each block against each place of its window of twice its length."""
    rows, b = blocks.shape
    padded = np.zeros((rows, 2 * b))
    padded[:, :b] = blocks
    turned = transform(padded)[:, -np.arange(2 * b)]
    both = transform(_reduce(turned * transform(windows)), inverse=True)[:, : b + 1]
    factor = 2 * pow(2 * b, -1, PRIME) % PRIME
    own = _reduce(_reduce(blocks * blocks).sum(axis=1))
    return _reduce(own[:, None] + squares - _reduce(both * factor))


def _zeros(values: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Block starts and distances without mismatch, at one scale."""
    b = min(scale, LARGEST)
    low, high = (1 if scale == LEAST else scale), 2 * scale
    blocks, windows = sliding_window_view(values, b), sliding_window_view(values, 2 * b)
    for first in range(low, high, b):
        inside = starts + first + b <= ends
        at, end = starts[inside], ends[inside]
        for i in range(0, len(at), max(ROW_WORDS // b, 1)):
            s, e = at[i : i + max(ROW_WORDS // b, 1)], end[i : i + max(ROW_WORDS // b, 1)]
            places = s[:, None] + first + np.arange(b + 1)
            squares = _reduce((sums[places + b] - sums[places]).astype(np.float64))
            row, step = np.nonzero(mismatches(blocks[s], windows[s + first], squares) == 0)
            distance = first + step
            good = (step < b) & (distance < high) & (s[row] + b + distance <= e[row])
            yield s[row[good]], distance[good]


def _agreeing(ids: np.ndarray, at: int, d: int, step: int, bound: int) -> int:
    """How far words and those ``d`` on agree from ``at``, going right (1) or left (-1) to the bound."""
    size, start = 64, at
    while (at < bound) if step > 0 else (at > bound):
        if step > 0:
            n = min(size, bound - at)
            differ = ids[at : at + n] != ids[at + d : at + d + n]
        else:
            n = min(size, at - bound)
            differ = (ids[at - n : at] != ids[at - n + d : at + d])[::-1]
        if differ.any():
            return abs(at + step * int(differ.argmax()) - start)
        at, size = at + step * n, size * 2
    return abs(at - start)


def _settle(ids: np.ndarray, low: int, high: int, at: np.ndarray, far: np.ndarray, b: int, runs: list[tuple[int, int, int]]) -> None:
    """Extend the zeros of one text at one scale, and add the runs that they lie in: start, end, period."""
    order = np.argsort(at, kind="stable")
    at, far = at[order], far[order]
    open_ = np.ones(len(at), bool)

    def close(start: int, end: int, period: int) -> None:
        i, j = np.searchsorted(at, (start, end - b))
        inside = (at[i:j] + b + far[i:j] <= end) & (far[i:j] % period == 0)
        open_[i:j] &= ~inside

    least = b + int(far.min())
    for start, end, period in runs:
        if end - start >= least:
            close(start, end, period)
    for k in np.lexsort((at, far)):
        if not open_[k]:
            continue
        s, d = int(at[k]), int(far[k])
        if not np.array_equal(ids[s : s + b], ids[s + d : s + d + b]):
            continue
        start = s - _agreeing(ids, s, d, -1, low)
        end = s + b + _agreeing(ids, s + b, d, 1, high - d) + d
        close(start, end, d)
        if end - start >= max(MIN_LENGTH, MIN_REPEATS * d):
            runs.append((start, end, d))


def find_runs(ids: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs of each text as start, length and period, by start and period.

    ``ids`` are the words of all texts, one text behind the other from its offset on; ``values``
    are residues, equal for equal words.
    """
    sizes = np.diff(offsets)
    longest = int(sizes.max(initial=0))
    padded = np.concatenate([values.astype(np.float64), np.zeros(4 * min(max(longest, LEAST), LARGEST) + 2 * LEAST)])
    squares = _reduce(padded * padded).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(squares)])
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    scale = LEAST
    while (1 if scale == LEAST else scale) * MIN_REPEATS <= longest:
        b, low = min(scale, LARGEST), (1 if scale == LEAST else scale)
        long = np.flatnonzero(sizes >= max(MIN_LENGTH, MIN_REPEATS * low))
        counts = (sizes[long] - b - low) // scale + 1
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts, ends = np.repeat(offsets[long], counts) + inner * scale, np.repeat(offsets[long + 1], counts)
        zeros = list(_zeros(padded, sums, starts, ends, scale))
        at = np.concatenate([z[0] for z in zeros]) if zeros else np.empty(0, np.int64)
        far = np.concatenate([z[1] for z in zeros]) if zeros else at
        text = np.searchsorted(offsets, at, "right") - 1
        order = np.argsort(text, kind="stable")
        at, far, text = at[order], far[order], text[order]
        cuts = np.flatnonzero(np.diff(text)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(text)], strict=True):
            if j > i:
                t = int(text[i])
                _settle(ids, int(offsets[t]), int(offsets[t + 1]), at[i:j], far[i:j], b, found[t])
        scale *= 2
    return [sorted((s - int(o), e - s, q) for s, e, q in runs) for runs, o in zip(found, offsets, strict=False)]


def _residue(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") % PRIME - PRIME // 2


def runs_of(values: list[bytes | None]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """Words and runs of each text."""
    words = [[w for piece in pieces(v or b"") for w in piece.split()] for v in values]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for ws in words for w in ws), np.int64)
    residues = np.fromiter(map(_residue, seen), np.int64, len(seen))
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    return words, find_runs(ids, residues[ids] if len(ids) else ids, offsets)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by a space: of each run its first period stays, unless another drops it."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.cumsum(edges[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _groups(values: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Texts of a bounded number of words together; a longer one alone."""
    group, held = [], 0
    for v in values:
        size = len(v or b"") // 4
        if group and held + size > GROUP_WORDS:
            yield group
            group, held = [], 0
        group.append(v)
        held += size
    if group:
        yield group


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for group in _groups(texts(batch.column(1))):
            words, runs = runs_of(group)
            short = [collapsed(w, r) for w, r in zip(words, runs, strict=True)]
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(done, len(group)), pa.array([len(w) for w in words], pa.int64()), pa.array(rows, RUNS),
                 pa.array(short, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])
            done += len(group)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (start, length, period, by start and period) and ``collapsed`` of every row.

    ``collapsed`` is the text without what its runs repeat, one space between words. Null and
    empty texts have no words, no runs and an empty ``collapsed``. Runs that overlap are all
    given; the same stretch is given once, with its smallest period. Rows are looked at one by
    one, so repeated rows and null ids pass through; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        _searched, f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
