"""Operators that look at one text at a time, against plain Python."""

from __future__ import annotations

import tracemalloc
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterlode.llm import containment, licenses, lm_score, repetition, token_counts
from quarterlode.llm import context_tree as T
from quarterlode.llm.common import prepare


# repetition

def repeats_by_hand(words):
    n, found = len(words), []
    for i in range(n):
        best = 0
        for j in range(n):
            if i != j:
                m = 0
                while max(i, j) + m < n and words[i + m] == words[j + m]:
                    m += 1
                best = max(best, m)
        found.append(best)
    return found


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=6), st.integers(1, 30), st.lists(st.integers(0, 2), max_size=50))
def test_longest_repeats_of_long_periods(unit, times, tail):
    words = (unit * times + tail + unit * times)[:150]
    assert repetition.longest_repeats(np.array(words, np.int64)).tolist() == repeats_by_hand(words)


def test_longest_repeats_in_linear_memory():
    """Equal words and a text written twice: memory per word is fixed, whatever repeats."""
    n = 1_000_000
    twice = np.tile(np.random.default_rng(7).integers(0, 50_000, n // 2), 2)
    for words in (np.zeros(n, np.int64), twice):
        tracemalloc.start()
        found = repetition.longest_repeats(words)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80 * n
        if words is twice:
            assert (found[: n // 2] >= np.arange(n // 2, 0, -1)).all() and found[0] == n // 2
        else:
            assert found[0] == n - 1 and found[n // 2] == n // 2 and found[-1] == 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=24))
def test_longest_repeats(words):
    assert repetition.longest_repeats(np.array(words, np.int64)).tolist() == repeats_by_hand(words)


def test_quality_of_odd_texts(spark):
    line = "the same line of words here again"
    texts = [None, "", "   \n ", "word", " ".join(f"w{i}" for i in range(40)), "\n".join([line] * 9), "é# ü$\né# ü$", "a " * 200_000]
    df = prepare(spark).createDataFrame([(i if i else None, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, n_words int")
    got = {r.doc_id or 0: r for r in repetition.repetition(df).collect()}
    assert [got[i].n_words for i in range(8)] == [0, 0, 0, 1, 40, 63, 4, 200_000]
    assert [got[i].kept for i in range(8)] == [False] * 4 + [True] + [False] * 3
    assert got[5].n_dup_lines == 8 and got[5].n_repeat_words == 63 and got[6].n_dup_lines == 1
    assert (got[6].word_chars, got[6].n_symbols) == (8, 4)
    assert [r.doc_id for r in repetition.keep_good(df).collect()] == [4]
    assert repetition.repetition(df.limit(0)).collect() == []


# token counts

WORDS = st.sampled_from(["a", "b's", "it'll", " ", "  ", "\n", "\t x", "é", "<|endoftext|>", "12", "3.4", ",", "the", " ", "\x1c", "👍"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(WORDS, max_size=12).map(" ".join) | st.lists(WORDS, max_size=12).map("".join), max_size=5))
def test_lengths_are_the_library_s(values):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(values, add_special_tokens=False)]
    assert token_counts.count_tokens(values, path, 16) == want


def test_token_counts_of_nulls_and_long_texts(spark):
    df = prepare(spark).createDataFrame([(None, None, 1), (1, "", 1), (1, "word " * 30_000, 1)], "doc_id long, text string, id int")
    got = token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert [(r.doc_id, r.n_bytes, r.over_limit) for r in got] == [(None, 0, False), (1, 0, False), (1, 150_000, True)]


# containment

def contained_by_hand(docs, items):
    found = []
    for i, doc in enumerate(docs):
        own = (doc or "").lower().split()
        for k, item in enumerate(items):
            words = (item or "").lower().split()
            n = min(len(words), 5)
            runs = lambda w, n=n: {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
            if n and 100 * len(runs(words) & runs(own)) >= 80 * len(runs(words)):
                found.append((i, k, len(runs(words)), len(runs(words) & runs(own))))
    return sorted(found)


def test_short_items_in_long_documents(spark):
    rng = random.Random(6)
    docs = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 2) for _ in range(rng.choice((0, 2, 7, 400)))) for _ in range(60)] + [None]
    items = [" ".join(rng.choice("abcdefghijklmnop") for _ in range(n)) for n in (1, 2, 2, 3, 3, 4, 4, 5, 6) for _ in range(6)] + ["A", "a", "", None]
    prepare(spark)
    d = spark.createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id int, text string, key int")
    b = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id int, text string, h int")
    want = contained_by_hand(docs, items)
    for block in (containment.BLOCK, 10):
        got = containment.contained(d, b, block=block)
        assert sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got.collect()) == want
    # a larger table of items leaves the plan as it is
    plans = [len(containment.contained(d, b.where(f"item_id < {n}"), block=5)._jdf.queryExecution().optimizedPlan().toString().splitlines()) for n in (20, 50)]
    assert plans[0] == plans[1]


def test_contained_items(spark):
    rng = random.Random(5)
    items = [" ".join(f"i{k}_{j}" for j in range(rng.randrange(6, 60))) for k in range(20)] + ["", None, "three short words"]
    docs = []
    for k in range(60):
        words = [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 3000))]
        taken = items[rng.randrange(20)].split()
        taken[rng.randrange(len(taken))] = "changed"
        at = rng.randrange(len(words) + 1)
        docs.append(" ".join(words[:at] + taken * (k % 2) + words[at:]))
    docs += [items[0], items[1].upper(), None, "", "three short words", "and three short words"]
    d = prepare(spark).createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id int, text string, item int")
    b = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id int, text string, doc int")
    want = contained_by_hand(docs, items)
    assert len(want) > 20 and {n for _, _, n, _ in want} > {1}
    long = {k for k, t in enumerate(items) if len((t or "").split()) >= 5}
    for block in (containment.BLOCK, 100):
        got = containment.contained(d, b, block=block)
        assert sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got.collect()) == want
        left = containment.decontaminate(d, b, block=block)
        assert {r.doc_id for r in left.collect()} == set(range(len(docs))) - {w[0] for w in want if w[1] in long}
        left = containment.decontaminate(d, b, block=block, least_words=1)
        assert {r.doc_id for r in left.collect()} == set(range(len(docs))) - {w[0] for w in want}
    assert containment.contained(d, b.limit(0)).collect() == []
    assert containment.decontaminate(d, b.limit(0)).count() == len(docs)


# licenses

def test_license_scan(spark):
    mit = dict(enumerate(licenses.TEMPLATES))[2][1]
    broken = mit.replace("free of charge", "completely free of any charge").split()
    texts = [None, "", "Released under the MIT License.", "x " * 50 + "MIT license and the GENERAL public-license", " ".join(broken),
             " ".join(broken[:20]), "Licensed under CC BY-NC 4.0.\n" * 3, "no licence at all", "mit-license"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[2])]
    df = prepare(spark).createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, template int")
    got = defaultdict(list)
    for r in licenses.scan_licenses(df).collect():
        got[r.doc_id].append(r)
    assert len(got[2]) == 2 and len(got[None]) == 1
    one = {i: v[0] for i, v in got.items()}
    assert [one[i].n_words for i in (0, 1, 2, 7, 8)] == [0, 0, 5, 4, 2]
    assert (one[3].n_base, one[3].first_word, one[3].last_word, one[3].base_labels) == (2, 50, 54, "gpl,mit")
    assert (one[4].base_labels, one[4].labels) == ("", "mit") and one[4].score > 0.9
    assert (one[5].labels, one[7].labels, one[7].score) == ("", "", 0.0) and 0 < one[5].score < 0.75
    assert one[6].labels == "cc-by-nc" and one[6].score == 1.0 and len(one[6].spans) == 3
    assert one[8].base_labels == one[8].labels == "mit"
    assert licenses.scan_licenses(df.limit(0)).collect() == []


# language model

def tree_by_hand(texts):
    """Context-tree weighting with dictionaries and recursion."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(text):
        padded = T.EDGE * T.DEPTH + text.lower() + T.EDGE
        for at in range(T.DEPTH, len(padded)):
            context = padded[at - T.DEPTH : at][::-1]
            for i in range(8):
                yield context, (1 << i) | (padded[at] >> (8 - i)), (padded[at] >> (7 - i)) & 1

    for text in texts:
        for context, node, bit in steps(text):
            for d in range(T.DEPTH + 1):
                counts[context[:d], node][bit] += 1
                if d:
                    children[context[: d - 1], node].add(context[:d])

    def own(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(z + o + 1)

    known = {}

    def weighted(context, node):
        if (context, node) not in known:
            mine = own(*counts[context, node])
            if len(context) == T.DEPTH:
                known[context, node] = (1.0, mine)
            else:
                below = sum(weighted(c, node)[1] for c in children[context, node])
                top = max(mine, below)
                total = math.log(math.exp(mine - top) + math.exp(below - top)) + top
                known[context, node] = (math.exp(mine - total), total + math.log(0.5))
        return known[context, node]

    def probability(context, node, bit, d=0):
        if (context[:d], node) not in counts:
            return 0.5
        z, o = counts[context[:d], node]
        mine = ((o if bit else z) + 0.5) / (z + o + 1)
        if d == T.DEPTH:
            return mine
        w = weighted(context[:d], node)[0]
        return w * mine + (1 - w) * probability(context, node, bit, d + 1)

    return lambda text: sum(math.log10(probability(c, n, b)) for c, n, b in steps(text))


@pytest.mark.parametrize("chunk_bytes", [lm_score.CHUNK, 40])
def test_scores_equal_a_tree_by_hand(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(lm_score, "PIECE", 64)
    texts = ["the cat sat on the mat", "The CAT sat", "", None, "ünïcode wörds ünïcode", "the dog sat on the log", "zzz", "the cat"]
    held = [False, False, False, False, False, True, True, False]
    rows = [(i, t, h, 0) for i, (t, h) in enumerate(zip(texts, held, strict=True))] + [(7, "the cat", False, 0), (None, "the", True, 0)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, held boolean, score int")
    got = lm_score.score_texts(df, F.col("held"), chunk_bytes=chunk_bytes).collect()
    assert len(got) == len(rows)
    train = [(r[1] or "").encode() for r in rows if not r[2]]
    model = tree_by_hand(train)
    words = Counter(w for t in train for w in [*t.lower().split(), b"\xff end"])
    n, v = sum(words.values()), len(words)
    want = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        text = want[r.doc_id]
        tokens = [words.get(w, 0) for w in [*text.lower().split(), b"\xff end"]]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c > 0 for c in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in tokens))
        assert r.score == pytest.approx(model(text))


def test_a_trained_model_is_a_distribution(spark):
    df = prepare(spark).createDataFrame([(1, "abab abba baba", False)], "doc_id long, text string, held boolean")
    more = spark.createDataFrame([(i, chr(i), True) for i in range(128) if not 65 <= i < 91], "doc_id long, text string, held boolean")
    rows = lm_score.score_texts(df.union(more), F.col("held")).where("held_out").collect()
    assert sum(10**r.score for r in rows) < 1
    assert lm_score.score_texts(df.limit(0), F.col("held")).collect() == []
    untrained = lm_score.score_texts(df, F.lit(True)).first()
    assert untrained.bits_per_byte == pytest.approx(8) and untrained.base_score == pytest.approx(0)


def test_held_out_texts_are_cheaper_than_noise(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiou") + rng.choice("bdlnrst") for _ in range(rng.randrange(1, 4))) for _ in range(80)]
    text = lambda: " ".join(rng.choice(words) for _ in range(120))
    rows = [(i, text(), i >= 80) for i in range(100)] + [(200, "".join(chr(rng.randrange(97, 123)) for _ in range(600)), True)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {r.doc_id: r.bits_per_byte for r in lm_score.score_texts(df, F.col("held")).where("held_out").collect()}
    assert max(v for k, v in got.items() if k < 200) < 3 < got[200]


