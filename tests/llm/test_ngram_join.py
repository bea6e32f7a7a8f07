"""Components against brute force: near copies, hubs, chains, ties, nulls and repeated rows."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterlode.llm import ngram_join
from quarterlode.llm.common import prepare
from quarterlode.llm.components import connected
from quarterlode.llm.ngram_join import keep_one, ngram_components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((name, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def family(rng, size, copies, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        yield " ".join(words)


def mixture(seed):
    rng = random.Random(seed)
    texts = [*family(rng, 140, 60, 6), *family(rng, 60, 40, 3), *family(rng, 12, 6, 1), "", None, "one", "ONE", "two words"]
    shared = " ".join(f"s{i}" for i in range(60))
    for _ in range(45):  # documents that share a passage and little else
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 120))]
        texts.append(f"{' '.join(own[:3])} {shared} {' '.join(own[3:])}")
    for cut in range(60, 141, 4):  # parts of one text
        texts.append(" ".join(f"c{i}" for i in range(cut)))
    ids = [*range(len(texts) - 2), None, 3]
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed,narrow", [(1, 32), (2, 3), (3, 1)])
def test_components_equal_brute_force(spark, seed, narrow):
    rows = mixture(seed)
    df = prepare(spark).createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string")
    got = ngram_components(df, narrow=narrow).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    df = prepare(spark).createDataFrame([], "doc_id long, text string")
    assert ngram_components(df).collect() == []


def test_families_of_thousands(spark):
    """Copies whose edits put them just within or just beyond reach of each other, in one family."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for _ in range(1_200):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 3, 4, 4, 5, 6, 8))):
            words[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    made = []

    def watched(pairs, sets, kept=ngram_join._overlaps):
        made.append(pairs.count())
        return kept(pairs, sets)

    original, ngram_join._overlaps = ngram_join._overlaps, watched
    try:
        got = ngram_components(df).collect()
    finally:
        ngram_join._overlaps = original
    want = {name: component for name, _, component in brute(rows)}
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) > 200
    assert sum(made) < 100_000  # of 720,000 pairs


def test_one_document_of_a_group_stays(spark):
    text, lone = " ".join(f"w{i}" for i in range(100)), " ".join(f"v{i}" for i in range(100))
    rows = [(4, text, "a"), (2, text.upper(), "b"), (2, "other words", "c"), (9, None, "d"), (8, None, "e"), (None, text, "f"), (2, text.upper(), "b"),
            (None, lone, "h"), (None, lone, "h"), (None, lone + " more", "h"), (None, None, "i"), (None, None, "i")]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, row string")
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.row for r in kept.collect()) == ["b", "c", "d", "e", "h", "i", "i"]
    assert keep_one(df.limit(0)).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_connected(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    reach = {x: {x} for link in links for x in link}
    for _ in reach:
        for a, b in links:
            reach[a] = reach[b] = reach[a] | reach[b]
    want = {x: min(r) for x, r in reach.items() if any(a != b and x in (a, b) for a, b in links)}
    assert {r.node: r.root for r in connected(df).collect()} == want
