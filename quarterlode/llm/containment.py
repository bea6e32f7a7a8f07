"""Benchmark decontamination: size-partitioned MinHash containment search.

An item of ``n`` distinct shingles is contained in a document that has at least
``need = ceil(percent * n / 100)`` of them. Its sketch is its ``n - need + 1``
smallest shingle hashes (bottom-k MinHash, with k from the item's size): at most
``n - need`` shingles may be missing, so a document that contains the item has one
of the sketch at least, and the search has full recall for documents of any length.
Items are partitioned by size, and a document looks only into partitions whose items
are small enough for it. Every candidate is verified over its exact shingle set. An item
of fewer words than a shingle is one run of its own length, looked for as such.

Items of up to a block of shingles go to every task, and documents are read once, in
place. More items are a table like the documents: sketch hashes are joined with the
documents' shingles, and candidates with both sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlode.llm.common import concatenated, shingle_set, texts, window_hashes, word_hashes
from quarterlode.session import materialise

# Shingles of the items that go to every task, 8 bytes each; with more the search is a join.
BLOCK = 2_000_000


def _item_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t) for t in texts(batch.column(1))]
            found = [shingle_set(w, size).view(np.int64) for w in words]
            run_words = [min(len(w), size) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), concatenated(found, pa.int64()), pa.array(run_words, pa.int32())], ["item", "shingles", "run"])

    return run


def document_set(words: np.ndarray, size: int, short: list[int]) -> np.ndarray:
    """Distinct shingles of a document, and its runs of the lengths that short items have, ascending."""
    runs = [window_hashes(words, n) for n in short]
    own = window_hashes(words, size)
    return np.unique(np.concatenate([own, *runs])) if runs else np.unique(own)


class Sketches:
    """Sketches of items: per size partition the hashes in order, and whose they are."""

    def __init__(self, sets: list[np.ndarray], percent: int, short: list[int]):
        self.sets, self.short = sets, short
        need = [(percent * len(s) + 99) // 100 for s in sets]
        self.need = need
        parts: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if len(s):
                parts.setdefault(len(s).bit_length(), []).append(i)
        self.parts = []
        for size in sorted(parts):
            members = parts[size]
            sketch = [sets[i][: len(sets[i]) - need[i] + 1] for i in members]
            owner = np.repeat(members, [len(s) for s in sketch])
            flat = np.concatenate(sketch)
            order = np.argsort(flat, kind="stable")
            self.parts.append((min(need[i] for i in members), flat[order], owner[order]))

    def search(self, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items contained in a document of these shingles and runs, and how many of their shingles it has."""
        for least, hashes, owner in self.parts:
            if len(found) < least:
                break  # the partitions that follow hold larger items
            low = np.searchsorted(hashes, found, "left")
            high = np.searchsorted(hashes, found, "right")
            hit = np.flatnonzero(high > low)
            if not len(hit):
                continue
            for i in np.unique(np.concatenate([owner[low[h] : high[h]] for h in hit])):
                at = np.searchsorted(found, self.sets[i])
                at[at == len(found)] = 0
                shared = int((found[at] == self.sets[i]).sum())
                if shared >= self.need[i]:
                    yield int(i), shared


class Items:
    """The items' shingle sets as a stored table; items without words are left out."""

    def __init__(self, items: DataFrame, item_col: str, item_text: str, size: int, percent: int, least_words: int):
        kind = items.schema[item_col].dataType.simpleString()
        sets = items.select(items[item_col], items[item_text]).mapInArrow(_item_sets(size), f"item {kind}, shingles array<bigint>, run int")
        self.table = materialise(sets.where(F.col("run") >= max(least_words, 1)), "items")
        self.size, self.percent, self.kind = size, percent, items.schema[item_col].dataType
        told = self.table.agg(F.sum(F.size("shingles")).alias("n"), F.collect_set(F.when(F.col("run") < size, F.col("run"))).alias("short")).first()
        self.shingles, self.short = told.n or 0, sorted(told.short)

    def sketches(self) -> tuple[Sketches, list]:
        """All items in memory, for a bounded number of shingles."""
        rows = self.table.toArrow()
        sets = [np.asarray(x.values, np.int64).view(np.uint64) for x in rows.column("shingles").combine_chunks()]
        return Sketches(sets, self.percent, self.short), rows.column("item").to_pylist()

    def joined(self, texts_: DataFrame) -> DataFrame:
        """``key, item, n_item, n_shared`` for texts ``key, text``, by joins of sketches with shingles and of candidates with sets."""
        size, short = self.size, self.short

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [document_set(word_hashes(t), size, short).view(np.int64) for t in texts(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), concatenated(found, pa.int64())], ["key", "held"])

        docs = texts_.mapInArrow(run, "key bigint, held array<bigint>").where(F.size("held") > 0)
        docs = materialise(docs.groupBy("key").agg(F.first("held").alias("held")), "document_sets")
        n = F.size("shingles")
        need = F.ceil(n * self.percent / 100).cast("int")
        items = self.table.groupBy("item", "shingles").agg(F.count(F.lit(1)).alias("copies"))
        items = materialise(items.withColumns({"n": n, "need": need, "of": F.xxhash64("item", "shingles")}), "item_sets")
        sketch = items.select("of", "need", F.explode(F.slice("shingles", 1, F.col("n") - F.col("need") + 1)).alias("h"))
        hashes = docs.select("key", F.size("held").alias("size"), F.explode("held").alias("h"))
        pairs = hashes.join(sketch, "h").where(F.col("size") >= F.col("need")).select("key", "of").distinct()
        both = pairs.join(items, "of").join(docs, "key").withColumn("n_shared", F.size(F.array_intersect("shingles", "held")))
        found = both.where(F.col("n_shared") >= F.col("need"))
        return found.select("key", "item", F.col("n").cast("bigint").alias("n_item"), F.col("n_shared").cast("bigint").alias("n_shared"),
                            F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def contained(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 80, block: int = BLOCK,
) -> DataFrame:
    """One row per document row and contained item: ids, ``n_item``, ``n_shared``, ``containment``.

    An item of fewer words than a shingle is contained where its words stand consecutively. Null and empty
    texts contain nothing and are contained in nothing. Repeated rows on either side give repeated rows;
    null ids are kept. Other columns are not looked at.
    """
    wanted = Items(items, item_col, item_text, size, percent, 1)
    kind = docs.schema[id_col].dataType.simpleString()
    texts_ = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    if wanted.shingles <= block:
        sketches, names = wanted.sketches()
        item_kind = wanted.kind.simpleString()
        out = texts_.mapInArrow(_pairs(sketches, names, size, wanted.kind), f"doc {kind}, item {item_kind}, n_item bigint, n_shared bigint")
    else:
        keyed = texts_.withColumn("key", F.xxhash64("text"))
        out = keyed.select("doc", "key").join(wanted.joined(keyed.select("key", "text")), "key")
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_item", "n_shared",
                      (F.col("n_shared") / F.col("n_item")).alias("containment"))


def _pairs(sketches: Sketches, names: list, size: int, kind):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, item, shared = [], [], []
            for i, text in enumerate(texts(batch.column(1))):
                for k, n in sketches.search(document_set(word_hashes(text), size, sketches.short)):
                    row.append(i)
                    item.append(k)
                    shared.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array([names[k] for k in item], arrow),
                 pa.array([len(sketches.sets[k]) for k in item], pa.int64()), pa.array(shared, pa.int64())],
                ["doc", "item", "n_item", "n_shared"])

    return run


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    size: int = 5, percent: int = 80, least_words: int | None = None, block: int = BLOCK,
) -> DataFrame:
    """The rows that contain no item of ``least_words`` words or more (a shingle's by default), with all their columns.

    Shorter items are left to ``contained``: a word or two stand in many clean documents. Null and empty texts stay,
    repeated rows stay or go together, and so do rows without an id.
    """
    at = docs.columns.index(text_col)
    wanted = Items(items, item_col, item_text, size, percent, size if least_words is None else least_words)
    if wanted.shingles > block:
        texts_ = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
        bad = wanted.joined(texts_).select(F.col("key").alias("_contaminated_")).distinct()
        return docs.join(bad, F.xxhash64(docs[text_col]) == bad["_contaminated_"], "left_anti")
    sketches, _ = wanted.sketches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (document_set(word_hashes(t), size, sketches.short) for t in texts(batch.column(at)))
            yield batch.filter(pa.array([next(sketches.search(s), None) is None for s in sets], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
