"""Token counts: batch encoding that returns lengths only.

A text is cut where a single space stands between two characters that are not white
space. There a byte-level pre-tokenizer always begins a new piece, so the lengths of
the pieces add up to the length of the text. Pieces that were met before are looked
up; new ones are encoded in runs of about equal bytes, and the bytes of the tokens tell
how many belong to each piece. Only integers leave a task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# White space next to white space, where a space is no safe boundary.
RUN = re.compile(r"\s\s")
PIECE_CHARS = 40  # longer pieces are rare and not remembered
REMEMBERED = 600_000  # pieces a worker remembers; the others are encoded again


class Encoder:
    """A tokenizer, the bytes of each of its tokens, and the pieces met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # a byte-level token has a character for each byte
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.known: dict[str, int] = {}

    def lengths(self, pieces: list[str], run_chars: int) -> dict[str, int]:
        """Tokens of each piece."""
        inner = [p for p in pieces if p[0] == " " and len(p) > 1 and not p[1].isspace() and not p[-1].isspace()]
        apart = set(pieces).difference(inner)
        found = {}
        for run in balanced(inner, run_chars):
            ids = self.tokenizer.encode_batch_fast(["".join(run)], add_special_tokens=False)[0].ids
            token_ends = np.cumsum(self.bytes[ids])
            ends = np.cumsum([len(p.encode()) for p in run])
            upto = np.searchsorted(token_ends, ends, "right")
            if len(ids) and np.array_equal(token_ends[upto - 1], ends):
                found.update(zip(run, np.diff(upto, prepend=0).tolist(), strict=True))
            else:  # never seen: a token that reaches over a boundary
                apart.update(run)
        for run in balanced(sorted(apart), run_chars):
            found.update(zip(run, map(len, self.tokenizer.encode_batch_fast(run, add_special_tokens=False)), strict=True))
        return found


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def safe_pieces(text: str) -> list[str]:
    """Pieces of a text that can be encoded one by one; joined they are the text."""
    parts = text.split(" ")
    if RUN.search(text) is None and not text[:1].isspace() and not text[-1:].isspace():
        return parts[:1] + [" " + p for p in parts[1:]]
    found, now = [], parts[0]
    for part in parts[1:]:
        if part and now and not part[0].isspace() and not now[-1].isspace():
            found.append(now)
            now = " " + part
        else:
            now += " " + part
    found.append(now)
    return found


def balanced(items: list[str], size: int) -> Iterator[list[str]]:
    """Batches of about ``size`` characters."""
    batch, held = [], 0
    for item in items:
        batch.append(item)
        held += len(item)
        if held >= size:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def count_tokens(values: list[str | None], path: str, batch_chars: int) -> list[int]:
    """Number of tokens of each text."""
    encoder = _encoder(path)
    known = encoder.known
    out = [0] * len(values)
    start = 0
    while start < len(values):
        # texts of about batch_chars at a time, so that their pieces fit into memory
        end, held = start, 0
        while end < len(values) and held < batch_chars:
            held += len(values[end] or "")
            end += 1
        cut = [[p for p in safe_pieces(v) if p] if v else [] for v in values[start:end]]
        fresh = encoder.lengths(list({p for pieces in cut for p in pieces if p not in known}), batch_chars)
        for i, pieces in enumerate(cut, start):
            out[i] = sum([known[p] if p in known else fresh[p] for p in pieces])
        if len(known) < REMEMBERED:
            known.update((p, n) for p, n in fresh.items() if len(p) <= PIECE_CHARS)
        start = end
    return out


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, batch_chars: int = 1 << 18,
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    ``path`` names a tokenizer file of the ``tokenizers`` library with a byte-level
    pre-tokenizer, at the same place on every machine. No begin, end or other special
    tokens are added; their strings in a text are read as the library does by default.
    Null and empty texts have none. Rows are counted one by one, so repeated rows and
    null ids pass through; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = count_tokens(texts, path, batch_chars)
            sizes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return found.withColumnRenamed("id", id_col)
