"""Quality rules on repetition: a suffix array over the words of each text.

Prefix doubling ranks the suffixes; neighbours in suffix order are compared in the order
of the text, which gives longest common prefixes in linear memory. A position whose suffix
shares ``m`` words with a neighbour starts a repeat of ``m`` words, the longest one
there, and every maximal repeated substring is the common prefix of an interval of
neighbours. The union of their spans is what the rules limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarterlode.llm.common import pieces, texts

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))
FIRST_WORDS = 32  # compared for all places at once; longer prefixes one by one


@dataclass(frozen=True)
class Limits:
    """What a text may have and still be kept."""

    min_words: int = 20
    window: int = 8  # of the base rule on repeated words
    max_repeat_percent: int = 30
    span: int = 5  # words a repeat has at least to count for the two below
    max_covered_percent: int = 30
    max_longest: int = 100


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; only the ranks of the last length are held."""
    n, key, step = len(ids), ids.astype(np.int64), 0
    while True:
        order = np.argsort(key, kind="stable")
        key = key[order]
        level = np.zeros(n, np.int64)
        np.cumsum(key[1:] != key[:-1], out=level[1:])
        if level[-1] == n - 1:
            return order
        rank = key
        rank[order] = level
        del order, level
        step = 2 * step or 1
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1


def _shared(ids: np.ndarray, a: int, b: int, done: int) -> int:
    """How many words the suffixes at two places share, if they share ``done``; compared in growing blocks."""
    size, end = 64, len(ids) - max(a, b)
    while done < end:
        size = min(2 * size, 1 << 16, end - done)
        differ = ids[a + done : a + done + size] != ids[b + done : b + done + size]
        if differ.any():
            return done + int(differ.argmax())
        done += size
    return done


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For each position, how many words from there on occur in the same order elsewhere.

    A suffix and the one before it in order share one word less than those a position
    earlier, if the words before both are equal. So only places where these differ are
    compared; what they share adds up to no more than 2 n log n words, and memory is a
    fixed number of arrays.
    """
    n = len(ids)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    order = suffix_array(ids)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    del order
    compare = np.ones(n, bool)
    later = np.flatnonzero(before[1:] > 0) + 1
    compare[later] = ids[later - 1] != ids[before[later] - 1]
    del later
    at = np.flatnonzero(compare & (before >= 0))
    live = np.arange(len(at))
    for done in range(FIRST_WORDS):
        if not len(live):
            break
        a, b = at[live] + done, before[at[live]] + done
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        live = live[ids[a] == ids[b]]
        found[at[live]] += 1
    for i in at[live].tolist():
        found[i] = _shared(ids, i, int(before[i]), FIRST_WORDS)
    del at, live
    base = np.where(compare, np.arange(n), 0)
    np.maximum.accumulate(base, out=base)
    found = found[base] - (np.arange(n) - base)
    del base
    has = np.flatnonzero(before >= 0)
    common = found[has]  # each position stands before at most one other
    found[before[has]] = np.maximum(found[before[has]], common)
    return found


def covered(repeats: np.ndarray, least: int) -> np.ndarray:
    """Whether each position lies in a repeat of at least ``least`` words."""
    edges = np.zeros(len(repeats) + 1, np.int64)
    starts = np.flatnonzero(repeats >= least)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + repeats[starts], -1)
    return np.cumsum(edges[:-1]) > 0


def _word_ids(text: bytes) -> np.ndarray:
    seen: dict[bytes, int] = {}
    parts = []
    for piece in pieces(text):
        words = piece.split()
        parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
    return np.concatenate(parts)


def measure(text: bytes | None, limits: Limits) -> tuple:
    """The counts of one text, and the verdicts."""
    text = text or b""
    ids = _word_ids(text)
    n = len(ids)
    repeats = longest_repeats(ids)
    repeated = int(covered(repeats, limits.window).sum())
    inside = int(covered(repeats, limits.span).sum())
    longest = int(repeats.max()) if n else 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    failed = n < limits.min_words or 100 * repeated > limits.max_repeat_percent * n
    kept = not failed and 100 * inside <= limits.max_covered_percent * n and longest <= limits.max_longest
    return (
        n, len(text.translate(None, SPACES + CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated, failed, kept, inside, longest)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "n_covered_words", "longest_repeat")
TYPES = ("bigint",) * 5 + ("boolean",) * 2 + ("bigint",) * 2


def _measured(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(measure(t, limits) for t in texts(batch.column(1))), strict=True)) or [()] * len(NAMES)
            arrays = [pa.array(c, pa.bool_() if t == "boolean" else pa.int64()) for c, t in zip(columns, TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", *NAMES])

    return run


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Counts and verdict of every row: ``id_col`` and ``NAMES``.

    Null and empty texts have no words and fail. Rows are looked at one by one, so
    repeated rows and null ids pass through; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fields = ", ".join(f"{n} {t}" for n, t in zip(NAMES, TYPES, strict=True))
    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        _measured(limits), f"id {kind}, {fields}")
    return found.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text passes all rules, with all their columns.

    Null and empty texts fail. Each row is judged by itself: repeated rows pass or fail
    together, null ids and columns of any name pass through.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = NAMES.index("kept")
            yield batch.filter(pa.array([measure(t, limits)[kept] for t in texts(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
