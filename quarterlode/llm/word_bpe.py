"""Encoding and decoding by byte pairs with word ends, with a lexicon of frequent words.

Texts are cut at blanks and line ends, where the tokenizer always begins anew. The words
between are counted over all texts; the most frequent ones are compiled with their ids into
a transducer (``lexicon.py``), one file that Spark hands to every executor. A word that is
not in the lexicon goes through the tokenizer's own normalizer and pre-tokenizer, and the
parts that these make of it are merged by rank. Each batch does this once for each of its
distinct words; a bounded number of words is remembered.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.llm.lexicon import Lexicon, compile_lexicon
from quarterlode.session import materialise, new_path

WORD_CHARS = 40  # longer words are rare and not remembered
REMEMBERED = 400_000  # words a worker remembers; the others are worked out again
LONG_WORD = 100  # characters of a part that is merged alone
LAST_CHARACTER = 0x200  # beyond the characters that stand for bytes
BLANK = re.compile(r"\s")
WORD_BYTES = 64  # longest word of a lexicon
BATCH_CHARS = 1 << 20  # of texts that are encoded together
FLUSHED = 300_000  # words that a task counts before it hands the counts on


def _ascii_pattern(normalizer: dict, pre_tokenizer: dict) -> regex.Pattern | None:
    """The pattern of words, if nothing else is done to printable ASCII than to lower its case."""
    steps = normalizer.get("normalizers", [])
    split, *rest = pre_tokenizer.get("pretokenizers", [{}])
    plain = (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
        and split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
        and [(r["type"], r["add_prefix_space"], r["use_regex"]) for r in rest] == [("ByteLevel", False, False)])
    return regex.compile(split["pattern"]["Regex"]) if plain else None


class Tokenizer:
    """What a tokenizer file says: its normalizer, pre-tokenizer, vocabulary, merges and special strings."""

    def __init__(self, path: str):
        import tokenizers

        library = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, added = told["model"], told["added_tokens"]
        if model["type"] != "BPE" or model["unk_token"] or model["byte_fallback"] or model["dropout"] or model["ignore_merges"]:
            raise ValueError("a byte pair model without unknown tokens is needed")
        if told["decoder"] is not None or told["post_processor"] is not None:
            raise ValueError("decoders and post-processors are not known here")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("special strings must stand for themselves")
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.ascii = _ascii_pattern(told["normalizer"], told["pre_tokenizer"])
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        ids = [(self.vocabulary[a] << 20 | self.vocabulary[b], rank, self.vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)]
        self.pairs, self.pair_ranks, self.pair_ids = np.array(sorted(ids), np.int64).reshape(-1, 3).T.copy()
        characters = {c: i for c, i in self.vocabulary.items() if len(c) == 1}
        self.inner, self.final = np.full(LAST_CHARACTER, -1, np.int64), np.full(LAST_CHARACTER, -1, np.int64)
        for c, i in characters.items():
            self.inner[ord(c)], self.final[ord(c)] = i, self.vocabulary[c + self.end]
        self.special = {a["content"]: a["id"] for a in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.known: dict[str, bytes] = {"": b""}
        self.tokens = {i: t for t, i in (*self.vocabulary.items(), *self.special.items())}

    def words(self, piece: str) -> list[str]:
        """Words of a piece of text, in the characters that stand for its bytes."""
        return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece))]

    def _cut(self, piece: str) -> list[str | int]:
        if self.specials is None or self.specials.search(piece) is None:
            return self.words(piece)
        found: list[str | int] = []
        for i, part in enumerate(self.specials.split(piece)):
            found += [self.special[part]] if i % 2 else self.words(part) if part else []
        return found

    def cut(self, pieces: list[str]) -> dict[str, list[str | int]]:
        """Words of each piece, and ids of the special strings in it.

        Of letters A to Z or printable ASCII, the pattern is the same in Python. Other pieces without white space are
        joined by blanks and read at once; a word never reaches over a blank.
        """
        found: dict[str, list[str | int]] = {}
        plain = []
        for p in pieces:
            if self.specials is not None and "<" in p and self.specials.search(p) is not None:
                continue
            if self.ascii is not None and p.isascii() and p.isprintable():
                found[p] = [p.lower()] if p.isalpha() else self.ascii.findall(p.lower())
            elif p and BLANK.search(p) is None:
                plain.append(p)
        text = self.normalizer.normalize_str(" ".join(plain))
        parts = text.split(" ")
        if len(parts) == len(plain):
            ends = list(accumulate(len(p) + 1 for p in parts))
            words, at = [[] for _ in plain], 0
            for word, (start, _) in self.pre_tokenizer.pre_tokenize_str(text):
                while start >= ends[at]:
                    at += 1
                words[at].append(word)
            found.update(zip(plain, words, strict=True))
        for p in pieces:
            if p not in found:
                found[p] = self._cut(p)
        return found

    def merge(self, word: str) -> list[int]:
        """Ids of a word: of all neighbours that may be merged, those of the least rank first, from the left."""
        parts = list(word)
        parts[-1] += self.end
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        ranks = self.ranks
        heap = [(ranks[pair], i, pair) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= len(parts) or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(parts) and (own := (parts[left], parts[right])) in ranks:
                    heapq.heappush(heap, (ranks[own], left, own))
        return [self.vocabulary[p] for p in parts if p]

    def _pair_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the sorted pairs; one past the last if it may not be merged."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, at, len(self.pairs))

    def merge_all(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words: each round merges one pair of every word that has one, as ``merge`` does."""
        found = {w: self.merge(w) for w in words if len(w) > LONG_WORD}
        words = [w for w in words if w not in found]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        ids, last = self.inner[flat], np.cumsum(sizes) - 1
        ids[last] = self.final[flat[last]]
        none = len(self.pair_ranks)
        ranks = np.append(self.pair_ranks, none)  # a rank is less than their number
        pair = np.full(len(ids), none)
        same = np.flatnonzero(word[:-1] == word[1:])
        pair[same] = self._pair_at(ids[same], ids[same + 1])
        done_words, done_ids = [], []
        while len(ids):
            rank = ranks[pair]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(ids)))
            open_ = least < none
            if not open_.all():
                done_words.append(word[~open_])
                done_ids.append(ids[~open_])
                ids, word, pair, rank, least = ids[open_], word[open_], pair[open_], rank[open_], least[open_]
            at = np.flatnonzero(rank == least)
            at = at[np.append(True, word[at][1:] != word[at][:-1])] if len(at) else at
            ids[at] = self.pair_ids[pair[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, pair = ids[keep], word[keep], pair[keep]
            at -= np.arange(len(at))
            for i in (at, at - 1):
                i = i[(i >= 0) & (i + 1 < len(ids))]
                pair[i] = np.where(word[i] == word[i + 1], self._pair_at(ids[i], ids[i + 1]), none)
            if len(pair):
                pair[-1] = none
        word, ids = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (done_words, done_ids))
        order = np.argsort(word, kind="stable")
        flat_ids, ends = ids[order].tolist(), np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        found.update((w, flat_ids[i:j]) for w, i, j in zip(words, [0, *ends], ends, strict=False))
        return found


    def encode(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, as little-endian unsigned integers of 32 bits."""
        cut = self.cut(pieces)
        merged = self.merge_all(list({w for own in cut.values() for w in own if isinstance(w, str)}))
        flat, ends = [], [0]
        for own in cut.values():
            for w in own:
                flat += merged[w] if isinstance(w, str) else (w,)
            ends.append(4 * len(flat))
        data = np.array(flat, "<u4").tobytes()
        return {p: data[i:j] for p, i, j in zip(cut, ends, ends[1:], strict=False)}


@lru_cache(maxsize=1)
def tokenizer_at(path: str) -> Tokenizer:
    """The tokenizer of a file, read once by each worker."""
    return Tokenizer(path)


def words_of(text: str | None) -> list[str]:
    """What stands between the blanks and line ends of a text; some of it may be empty."""
    return text.replace("\n", " ").split(" ") if text else []


class Encoder:
    """A tokenizer, a lexicon, and the words met so far, whose ids no lexicon changes."""

    def __init__(self, path: str, lexicon: Lexicon | None):
        self.tokenizer, self.lexicon = tokenizer_at(path), lexicon
        self.known = self.tokenizer.known

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words: from the lexicon, else by merging the parts of each."""
        found: dict[str, bytes] = {}
        if self.lexicon is not None and words:
            for word, place in zip(words, self.lexicon.places([w.encode() for w in words]).tolist(), strict=True):
                if place >= 0:
                    found[word] = self.lexicon.ids_of(place)
        found.update(self.tokenizer.encode([w for w in words if w not in found]))
        return found

    def encode(self, values: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of 32 bits."""
        known = self.known
        cut = [words_of(v) for v in values]
        found = [list(map(known.get, own)) for own in cut]
        open_ = [i for i, own in enumerate(found) if None in own]
        new = self._new(list({w for i in open_ for w, ids in zip(cut[i], found[i], strict=True) if ids is None}))
        for i in open_:
            found[i] = [new[w] if ids is None else ids for w, ids in zip(cut[i], found[i], strict=True)]
        if len(known) < REMEMBERED:
            known.update((w, ids) for w, ids in new.items() if len(w) <= WORD_CHARS)
        return [b"".join(own) for own in found]


def _runs(values: list[str | None], chars: int) -> Iterator[list[str | None]]:
    """Texts of about ``chars`` characters at a time."""
    run, held = [], 0
    for v in values:
        run.append(v)
        held += len(v or "")
        if held >= chars:
            yield run
            run, held = [], 0
    if run:
        yield run


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            counts.pop("", None)
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(words_of(value))
                if len(counts) >= FLUSHED:
                    yield flush()
                    counts.clear()
        yield flush()

    return docs.select(docs[text_col]).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _class(count: str) -> Column:
    """Class of a frequency: a thousand at most, whatever the counts."""
    return F.floor(F.log2(count) * 16).cast("int")


def build_lexicon(spark: SparkSession, docs: DataFrame, path: str, text_col: str = "text", size: int = 65_536) -> str | None:
    """Compile the most frequent words of all texts; the name under which executors find the file.

    Words are taken by classes of frequency, sixteen to each doubling, as long as all taken are no more than ``size``.
    Words above ``WORD_BYTES`` are not taken. If no class fits, or the table is empty, there is no lexicon.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [w for batch in batches for w in batch.column(0).to_pylist()]
        ids = tokenizer_at(path).encode(words)
        data = compile_lexicon((w.encode(), ids[w]) for w in sorted(words, key=str.encode))
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["lexicon"])

    counted = materialise(count_words(docs, text_col).where(F.octet_length("word") <= WORD_BYTES).withColumn("rank", _class("n")), "words")
    least, held = None, 0
    for row in counted.groupBy("rank").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("rank")).collect():
        held += row["words"]
        if held > size:
            break
        least = row["rank"]
    if least is None:
        return None
    chosen = counted.where(F.col("rank") >= least).select("word").repartition(1)
    folder = new_path(spark, "lexicon")
    # the text writer puts bytes down as they are
    chosen.mapInArrow(run, "lexicon binary").select(F.col("lexicon").cast("string")).write.text(folder)
    file = spark.read.format("binaryFile").load(folder).select("path", "length").orderBy(F.desc("length")).first()
    if file is None:
        return None
    spark.sparkContext.addFile(file["path"])
    return file["path"].rpartition("/")[2]


@lru_cache(maxsize=2)
def _encoder(path: str, lexicon: str | None) -> Encoder:
    return Encoder(path, None if lexicon is None else Lexicon(SparkFiles.get(lexicon)))


def encode(docs: DataFrame, path: str, lexicon: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` of every row: little-endian unsigned integers of 32 bits.

    ``path`` names a file of the ``tokenizers`` library, at the same place on every machine; the ids are those that the
    library gives without begin and end, truncation or padding, with special strings inside texts taken as special.
    ``lexicon`` is what ``build_lexicon`` returns; without it all words are merged. Null and empty texts have no ids.
    Rows are encoded one by one, so repeated rows and null ids pass through; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, lexicon)
        for batch in batches:
            done = 0
            for values in _runs(batch.column(1).to_pylist(), BATCH_CHARS):
                ids = encoder.encode(values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(ids)), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "n_tokens", "ids"])
                done += len(ids)

    found = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary")
    return found.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``ids`` and ``decoded`` of every row: the tokens, special ones too, with a space between them.

    Null and empty ids give an empty text; an id that the vocabulary lacks gives nothing, as in the library.
    """
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer_at(path).tokens
        table = [tokens.get(i) for i in range(max(tokens) + 1)]
        dense = None not in table
        for batch in batches:
            out = []
            for ids in batch.column(1).to_pylist():
                found = np.frombuffer(ids or b"", "<u4").tolist()
                out.append(" ".join(map(table.__getitem__, found)) if dense and max(found, default=0) < len(table)
                           else " ".join(t for i in found if (t := tokens.get(i)) is not None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["id", "ids", "decoded"])

    found = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids")).mapInArrow(run, f"id {kind}, ids binary, decoded string")
    return found.withColumnRenamed("id", id_col)
