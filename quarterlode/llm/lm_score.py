"""Scores of texts under a context tree and a word model, both learned from the corpus.

Neither model is ever in one place. Counts of grams and words are aggregated by key; the
tree is weighted in partitions that each hold whole subtrees, and only its top two levels,
at most 65,536 nodes whatever the corpus, go to all tasks. To score, documents are dealt
into chunks; each chunk asks once for every distinct gram and word that it holds, a
join answers, and the answers meet the chunk's texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlode.llm.common import texts, word_hashes
from quarterlode.llm.context_tree import DEPTH, EDGE, Roots, Subtrees, grams, log10_probability
from quarterlode.session import materialise

PIECE = 1 << 20  # bytes looked at together
GATHER = 1 << 24  # bytes whose counts a task folds before it hands them on
CHUNK = 24 << 20  # bytes of a chunk
PART = 2_000_000  # grams of a partition of the tree
END_WORD = -1
TOP = 2


def word_keys(text: bytes | None) -> np.ndarray:
    """Words as negative numbers, so that they never equal a gram."""
    return (word_hashes(text) | np.uint64(1 << 63)).view(np.int64)


def segments(values: list[bytes | None]) -> Iterator[tuple[list[tuple[bytes, bytes]], list[int]]]:
    """Lower-cased texts with their end, in groups of about ``PIECE`` bytes; long texts in several pieces."""
    group, owner, held = [], [], 0
    for i, text in enumerate(values):
        text = (text or b"").lower() + EDGE
        for start in range(0, len(text), PIECE):
            before = text[max(0, start - DEPTH) : start]
            group.append((EDGE * (DEPTH - len(before)) + before, text[start : start + PIECE]))
            owner.append(i)
            held += len(group[-1][1])
            if held >= PIECE:
                yield group, owner
                group, owner, held = [], [], 0
    if group:
        yield group, owner


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.sort(np.concatenate(parts)) if parts else np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(flat, prepend=flat[0] - 1)) if len(flat) else np.empty(0, np.int64)
    return flat[first], np.diff(first, append=len(flat))


def _fold(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(back, np.concatenate(counts), len(found)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts in training texts of grams and words; grams of held-out texts count 0, so that they get a probability."""
    pa.default_memory_pool().release_unused()  # what earlier tasks of this worker held
    keys, counts, held = [], [], 0
    for batch in batches:
        out = batch.column(0).to_numpy(zero_copy_only=False)
        values = texts(batch.column(1))
        for hold in (False, True):
            chosen = [v for v, h in zip(values, out, strict=True) if h == hold]
            for group, _ in segments(chosen):
                key, n = _distinct([grams(group)[0]])
                keys.append(key)
                counts.append(n * (not hold))
            if not hold and chosen:
                key, n = _distinct([word_keys(v) for v in chosen])
                keys += [key, np.array([END_WORD])]
                counts += [n, np.array([len(chosen)])]
        held += sum(len(v or b"") for v in values)
        if held >= GATHER:
            yield _key_batch(*_fold(keys, counts))
            keys, counts, held = [], [], 0
    yield _key_batch(*_fold(keys, counts))


def _key_batch(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["key", "n"])


def _partition(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, Subtrees]:
    found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    key = np.concatenate([k for k, _ in found]) if found else np.empty(0, np.int64)
    n = np.concatenate([c for _, c in found]) if found else np.empty(0, np.int64)
    order = np.argsort(key)
    key, n = key[order], n[order]
    return key, Subtrees(key[n > 0], n[n > 0], TOP)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, trees = _partition(batches)
    name, *sums = trees.tops()
    yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), *(pa.array(s, pa.float64()) for s in sums)], ["name", "zeros", "ones", "below"])


def _probabilities(roots: Roots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, trees = _partition(batches)
        for start in range(0, len(key), 1 << 18):
            part = key[start : start + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(log10_probability(part, trees, roots))], ["key", "value"])

    return run


def _asked(table: pa.Table) -> pa.Table:
    """Every distinct gram and word of a chunk."""
    values = texts(table.column("text").combine_chunks())
    parts = [_distinct([grams(group)[0]])[0] for group, _ in segments(values)]
    words = [_distinct([word_keys(v) for v in values[i : i + 256]])[0] for i in range(0, len(values), 256)]
    keys = np.concatenate([_distinct(parts)[0], _distinct(words)[0]])
    chunk = pa.array(np.full(len(keys), table.column("chunk")[0].as_py()), pa.int64())
    return pa.table({"chunk": chunk, "key": pa.array(keys, pa.int64())})


def _scored(tokens: int, distinct: int, ends: int):
    total = tokens + 0.1 * (distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key, value = right.column("key").to_numpy(), right.column("value").to_numpy()
        order = np.argsort(key)
        key, value = key[order], value[order]
        first_gram = int(np.searchsorted(key, 0))
        words, counts, known, logs = key[:first_gram], value[:first_gram], key[first_gram:], value[first_gram:]
        rows = texts(left.column("text").combine_chunks()) if left.num_rows else []
        score = np.zeros(len(rows))
        for group, owner in segments(rows):
            gram, piece = grams(group)
            if len(group) < 1 << 15:
                # piece numbers go below the grams, so that one sort serves the look-up and the sums
                both = np.sort(gram << 15 | piece)
                gram, piece = both >> 15, both & 0x7FFF
            sums = np.bincount(piece, logs[np.searchsorted(known, gram)], len(group))
            np.add.at(score, np.array(owner), sums)
        n_tokens, n_known, base = [], [], []
        for text in rows:
            asked = word_keys(text)
            c = counts[np.searchsorted(words, asked)] if len(words) else np.zeros(len(asked))
            c = np.append(c, ends)
            n_tokens.append(len(c))
            n_known.append(int((c > 0).sum()))
            base.append(float(np.log10((c + 0.1) / total).sum()))
        size = np.array([len(t or b"") + 1 for t in rows])
        return pa.table({
            "id": left.column("id"), "held_out": left.column("held_out"), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([tokens] * len(rows), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
            "bits_per_byte": pa.array(-score / np.log10(2) / size if len(rows) else [], pa.float64())})

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """Score of every row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte``.

    Both models learn from the rows where ``held_out`` is false. ``base_score`` is the
    word model's log10 probability, ``score`` the context tree's, with the end of the
    text; ``bits_per_byte`` counts the end as a byte. Null texts are empty and have
    only their end. Rows are scored one by one, null ids pass through, and repeated rows
    count as often as they stand there. Words are told apart by 63-bit hashes. Other
    columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), held_out.alias("held_out"), docs[text_col].alias("text"))
    counts = rows.select("held_out", "text").mapInArrow(_counts, "key bigint, n bigint")
    counts = materialise(counts.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    word, size = F.col("key") < 0, F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    seen = counts.agg(F.sum(F.when(word, F.col("n"))).alias("tokens"), F.count(F.when(word, 1)).alias("distinct"),
                      F.max(F.when(F.col("key") == END_WORD, F.col("n"))).alias("ends"), F.count(F.when(~word, 1)).alias("grams")).first()
    chunks = -(-(rows.agg(F.sum(size.cast("bigint"))).first()[0] or 1) // chunk_bytes)
    # all grams whose contexts end in the same two bytes are in one partition
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-seen.grams // PART))
    tree = counts.where(~word).repartition(parts, F.shiftright("key", 8 * (DEPTH - TOP + 1)))
    tops = tree.mapInArrow(_tops, "name bigint, zeros double, ones double, below double").groupBy("name").agg(
        *(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).orderBy("name").toArrow()
    roots = Roots(*(tops.column(c).to_numpy() for c in ("name", "zeros", "ones", "below")))
    values = tree.mapInArrow(_probabilities(roots), "key bigint, value double").unionByName(
        counts.where(word).select("key", F.col("n").cast("double").alias("value")))
    values = materialise(values, "values")
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    asked = dealt.groupBy("chunk").applyInArrow(_asked, "chunk bigint, key bigint")
    told = asked.join(values, "key", "left").select("chunk", "key", F.coalesce("value", F.lit(0.0)).alias("value"))
    schema = (f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, "
              "bits_per_byte double")
    tokens, distinct, ends = seen.tokens or 0, seen.distinct, seen.ends or 0
    scored = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_scored(tokens, distinct, ends), schema)
    return scored.withColumnRenamed("id", id_col)
