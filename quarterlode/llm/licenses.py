"""License scans by diagonal voting.

Rolling hashes of ``k`` words of every text are joined with the positions they have in
license templates. A hit votes for the diagonal *position in the text - position in the
template*. Neighbouring diagonals are merged, as an inserted or missing word moves the
rest of a notice by one, and a merged span is verified by the share of the template's
positions that it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quarterlode.llm.common import concatenated, pieces, texts, window_hashes
from quarterlode.llm.license_templates import PHRASES, TEMPLATES

TERM = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def term_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the letter-and-digit words of a text, A-Z lower-cased."""
    parts = []
    for piece in pieces(text or b""):
        terms = TERM.findall(piece.lower())
        parts.append(np.fromiter(map(xxh64_intdigest, terms), np.uint64, len(terms)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _phrase_starts(terms: np.ndarray, phrase: str) -> np.ndarray:
    words = [xxh64_intdigest(w.encode()) for w in phrase.split()]
    count = len(terms) - len(words) + 1
    if count <= 0:
        return np.empty(0, np.int64)
    same = np.ones(count, bool)
    for i, word in enumerate(words):
        same &= terms[i : i + count] == np.uint64(word)
    return np.flatnonzero(same)


def _scan(k: int, phrases: Sequence[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(6)]
            for text in texts(batch.column(2)):
                terms = term_hashes(text)
                found = [(_phrase_starts(terms, phrase), label) for phrase, label in phrases]
                starts = np.concatenate([s for s, _ in found])
                labels = sorted({label for s, label in found if len(s)})
                grams = np.concatenate([np.zeros(1, np.uint64), window_hashes(terms, k)])
                for column, value in zip(columns, (
                        len(terms), len(starts), int(starts.min()) if len(starts) else None,
                        int(starts.max()) if len(starts) else None, labels, grams.view(np.int64)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 pa.array(columns[4], pa.list_(pa.string())), concatenated(columns[5], pa.int64())],
                ["id", "text_key", "n_words", "n_base", "first_word", "last_word", "base", "grams"])

    return run


def template_positions(spark: SparkSession, templates: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """The given templates as rows: ``gram``, ``template``, ``label``, ``at``, ``positions``."""
    rows = []
    for i, (label, text) in enumerate(templates):
        grams = window_hashes(term_hashes(text.encode()), k).view(np.int64).tolist()
        rows += [(g, i, label, at, len(grams)) for at, g in enumerate(grams)]
    return spark.createDataFrame(rows, "gram bigint, template int, label string, at int, positions int")


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, slack: int = 3, least: float = 0.75,
    templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``spans``.

    ``base_*`` come from the phrases, ``spans`` (template, label, first and last word,
    share of the template) from the templates, each with at least ``least`` of its
    positions; ``score`` is the largest share of any. Diagonals up to ``slack`` apart are
    one span. Null and empty texts have no words. Repeated rows give repeated rows, null
    ids are kept, and other columns are not looked at. The templates are the caller's
    fixed list, so their table is broadcast.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    scanned = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_key"), docs[text_col].alias("text")).mapInArrow(
        _scan(k, phrases), f"id {kind}, text_key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base array<string>, grams array<bigint>")
    row = ["id", "text_key", "n_words", "n_base", "first_word", "last_word", "base"]
    grams = scanned.select(*row, F.posexplode("grams").alias("pos", "gram"))
    known = template_positions(docs.sparkSession, templates, k)
    # position 0 stands for the row itself, so that rows without a hit are kept in the same pass
    hits = grams.join(F.broadcast(known), "gram", "left").where("template is not null or pos = 0")
    votes = hits.groupBy(*row, "template", "label", "positions", (F.col("pos") - 1 - F.col("at")).alias("diagonal")).agg(
        F.count(F.when(F.col("pos") == 0, 1)).alias("rows"), F.collect_set("at").alias("ats"))
    by_diagonal = Window.partitionBy("id", "text_key", "template").orderBy("diagonal")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > slack).cast("int"), F.lit(1))
    merged = votes.withColumn("opens", opens).withColumn("span", F.sum("opens").over(by_diagonal))
    first = F.min(F.col("diagonal") + F.array_min("ats"))
    last = F.max(F.col("diagonal") + F.array_max("ats") + k - 1)
    spans = merged.groupBy(*row, "template", "label", "positions", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("held"), first.alias("first"), last.alias("last"),
        F.sum("rows").alias("rows"))
    share = F.col("held") / F.col("positions")
    verified = F.when(share >= least, F.struct("template", "label", "first", "last", share.alias("share")))
    judged = spans.groupBy(*row).agg(
        F.collect_list(verified).alias("spans"), F.max(share).alias("score"), F.max("rows").alias("rows"))
    every = F.array_sort(F.array_distinct(F.concat("base", "spans.label")))
    out = judged.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), F.array_sort("spans").alias("spans"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))
    return out.drop("copy")
