"""Words, shingles and row helpers that the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quarterlode.session import tune

SPACE = re.compile(rb"[\x20\x09-\x0d]")
# A word is a run of anything else than these six characters.
WORD = r"[^\x20\x09-\x0D]+"
PIECE = 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Small Arrow batches keep long texts within a worker's memory; shuffle files of a finished step are not needed again,
# as steps hand on written tables.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators of this package count on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def lower_ascii(column):
    """Lower-case A to Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Cut a long text at white space, so that its words never lie in memory all at once."""
    start = 0
    while len(text) - start > size:
        cut = SPACE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text in order, A-Z lower-cased."""
    found = []
    for piece in pieces(text or b""):
        words = piece.lower().split()
        found.append(np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)))
    return found[0] if len(found) == 1 else np.concatenate(found)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(xxh64_intdigest(b"mix 1") | 1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(xxh64_intdigest(b"mix 2") | 1)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` words, in order; none if there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, xxh64_intdigest(b"run of %d" % size), np.uint64)
    for i in range(size):
        total += words[i : i + count] * np.uint64(xxh64_intdigest(b"word %d" % i) | 1)
    return _mixed(total)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles, ascending; of a shorter text the whole sequence is one; no words, no shingle."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(words, min(size, len(words))))


def concatenated(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrow list column of numpy arrays."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
