"""Periodic runs, the word lexicon and the repair of conversations, against plain Python and the tokenizer library."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import SparkFiles
from tokenizers import Tokenizer

from quarterlode.llm import lexicon, periodic_runs, turn_repair, word_bpe
from quarterlode.llm.common import prepare

# periodic runs


def runs_by_hand(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.lists(st.tuples(st.floats(0, 1), st.integers(1, 70), st.integers(1, 300)), max_size=3),
                          st.integers(0, 330)), min_size=1, max_size=4), st.integers(0, 2**30))
def test_runs_of_many_texts(plans, seed):
    rng, texts = random.Random(seed), []
    for letters, repeats, n in plans:
        words = [rng.randrange(letters * letters) for _ in range(n)]
        for share, period, length in repeats:
            a = int(share * n)
            for i in range(a, min(a + length, n)):
                words[i] = words[a + (i - a) % period]
        texts.append(words)
    _, runs = periodic_runs.runs_of([" ".join(map(str, w)).encode() for w in texts])
    assert runs == [runs_by_hand(w) for w in texts]


@pytest.mark.parametrize("size", [2, 8, 64, 512, 4096])
def test_transform_and_mismatches_are_exact(size):
    rng = np.random.default_rng(size)
    x = rng.integers(0, periodic_runs.PRIME, (3, 2 * size))
    back = periodic_runs.transform(periodic_runs.transform(x.astype(float)), inverse=True).astype(np.int64)
    assert ((back - x * 2 * size) % periodic_runs.PRIME == 0).all()
    blocks, windows = x[:, :size], rng.integers(0, 3, (3, 2 * size))
    want = np.array([[((b - w[i : i + size]) ** 2).sum() for i in range(size + 1)] for b, w in zip(blocks, windows, strict=True)])
    squares = np.array([[(w[i : i + size] ** 2).sum() for i in range(size + 1)] for w in windows]) % periodic_runs.PRIME
    got = periodic_runs.mismatches(blocks.astype(float), windows.astype(float), squares.astype(float))
    assert ((got.astype(np.int64) - want) % periodic_runs.PRIME == 0).all()


def test_runs_longer_than_the_largest_block(monkeypatch):
    rng = random.Random(5)
    tail = [str(rng.randrange(10**6)) for _ in range(9_000)]
    words = [str(rng.randrange(10**6)) for _ in range(777)] + tail * 4
    assert periodic_runs.runs_of([" ".join(words).encode()])[1] == [[(777, 36_000, 9_000)]]
    monkeypatch.setattr(periodic_runs, "LARGEST", 16)
    for n in (1, 5, 40):
        words = [str(rng.randrange(50)) for _ in range(n)] * 7
        assert periodic_runs.runs_of([" ".join(words).encode()])[1][0] == runs_by_hand(words)


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \n ", "word", "a " * 300_000, "a b c " * 9, "a b c " * 7, "x " + "p q r s t u v w y " * 3]
    df = prepare(spark).createDataFrame([(i if i else None, t, 3, 4) for i, t in enumerate(texts + texts[5:6])], "doc_id int, text string, runs int, n int")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(df).collect()))
    assert got == [
        (0, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 1, [], "word"), (4, 300_000, [(0, 300_000, 1)], "a"), (5, 27, [(0, 27, 3)], "a b c"),
        (6, 21, [], "a b c a b c a b c a b c a b c a b c a b c"), (7, 28, [(1, 27, 9)], "x p q r s t u v w y"), (8, 27, [(0, 27, 3)], "a b c")]
    assert periodic_runs.periodic_runs(df.limit(0)).collect() == []


# word lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = st.sampled_from([
    "a", "B", "the ", "é", "É", "Σ", "İ", "ß", "\x1c", "\x85", "\xa0", " ", "​", " ", "  ", "\n", "\t", "\r\n", "\x00", "'s", "'S", "'ll",
    "12", "½", "漢字", "각", "ᄀ", "ᅡ", "👍🏽", "<|endoftext|>", "<|startoftext|>", "<|END", "|>", "...", "ǅ", "ﬁ", "ͅ", "K", "اّ", "supercalifragilistic"])


def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ODD, max_size=25).map("".join), min_size=1, max_size=6))
def test_ids_are_the_librarys(texts):
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    got = word_bpe.Encoder(PATH, None).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcdefgh", min_size=1, max_size=60), min_size=1, max_size=20))
def test_merging_together_and_alone(words):
    tokenizer = word_bpe.tokenizer_at(PATH)
    together = tokenizer.merge_all(list(set(words)))
    assert together == {w: tokenizer.merge(w) for w in words}


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=40), st.lists(st.text("abéc", max_size=8), max_size=20))
def test_lexicon(tmp_path_factory, words, others):
    keys = sorted(w.encode() for w in words)
    path = tmp_path_factory.mktemp("lexicon") / "file"
    path.write_bytes(lexicon.compile_lexicon((k, b"%d" % i + k) for i, k in enumerate(keys)) + b"\n")
    made = lexicon.Lexicon(str(path))
    asked = keys + [o.encode() for o in others]
    places = {k: i for i, k in enumerate(keys)}
    assert made.places(asked).tolist() == [places.get(k, -1) for k in asked]
    assert [made.ids_of(i) for i in range(len(keys))] == [b"%d" % i + k for i, k in enumerate(keys)]
    # minimal: as many states as there are different sets of endings
    starts = {k[:i] for k in keys for i in range(len(k) + 1)} or {b""}
    assert len(made.final) == len({frozenset(k[len(p):] for k in keys if k.startswith(p)) for p in starts})


def test_lexicon_over_a_table(spark):
    texts = ["the cat sat on the mat", "The cats' <|endoftext|>", None, "", " \n ", "z" * 30_000, "the cat sat on the mat", "x\ty the\n\nthe"]
    df = prepare(spark).createDataFrame([(i if i else None, t, b"") for i, t in enumerate(texts)], "doc_id int, text string, ids binary")
    name = word_bpe.build_lexicon(spark, df, PATH, size=6)
    held = lexicon.Lexicon(SparkFiles.get(name))
    assert len(held.offsets) == 6 and (held.places([b"the", b"cat", b"sat", b"on", b"mat"]) >= 0).all()
    assert word_bpe.build_lexicon(spark, df, PATH, size=0) is None
    counted = {r.word: r.n for r in word_bpe.count_words(df).collect()}
    assert counted["the"] == 6 and counted["cat"] == 2 and "" not in counted
    rows = {r.doc_id or 0: r for r in word_bpe.decode(word_bpe.encode(df, PATH, name), PATH).collect()}
    model = library()
    for i, text in enumerate(texts):
        ids = model.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids
        assert rows[i].decoded == model.decode(ids, skip_special_tokens=False)
    assert word_bpe.encode(df.limit(0), PATH, word_bpe.build_lexicon(spark, df.limit(0), PATH)).collect() == []


# repair of conversations


def cheapest_by_hand(rows):
    """Cheapest edits and the least letters among them: all ways to keep, rename, delete, with turns put in where roles ask for them."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        kept = [(e, r) for e, r in zip(edits, rows, strict=True) if e != "D"]
        if any(r.fault in ("blank", "duplicate") for _, r in kept):
            continue
        cost = sum({"D": 2, "K": 0, "R": 1}[e] for e in edits) + 5 * sum(r.fault == "truncated" for _, r in kept)
        # where turns are put in: at most two before each row and at the end
        for holes in itertools.product(range(3), repeat=len(rows) + 1):
            if best is not None and cost + 5 * sum(holes) > best[0]:
                continue
            letters, out = "", []
            for hole, e, r in zip(holes, edits, rows, strict=False):
                letters += "I" * hole + e
                out += [None] * hole + ([(e, r)] if e != "D" else [])
            letters, out = letters + "I" * holes[-1], out + [None] * holes[-1]
            system = bool(out) and out[0] is not None and out[0][0] == "K" and (out[0][1].role or "").startswith("s")
            roles, rest = (["s"] if system else []), out[1:] if system else out
            if len(rest) % 2 or system and not rest:
                continue
            lines, ok = [f"{out[0][1].role}:{out[0][1].text}"] if system else [], True
            for i, turn in enumerate(rest):
                role = "ua"[i % 2]
                name = {"u": "user", "a": "assistant"}[role]
                if turn is not None and turn[0] == "K":
                    ok, name = ok and (turn[1].role or "")[:1] == role, turn[1].role
                lines.append(f"{name}:{turn[1].text if turn else ''}")
            if ok and (best is None or (cost + 5 * sum(holes), letters) < best[:2]):
                best = cost + 5 * sum(holes), letters, lines
            assert roles is not None
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from([None, None, None, "blank", "duplicate", "truncated"])),
                max_size=4))
def test_cheapest_edits(rows):
    turns = [turn_repair.Turn(i, role, f"t{i}", fault) for i, (role, fault) in enumerate(rows)]
    search, edits = turn_repair.Survivors(), []
    for turn in turns:
        search.step(turn)
        edits += search.settled()
    edits += search.end()
    lines = [f"{e.role}:{e.row.text if e.row else ''}" for e in edits if e.letter != "D"]
    assert (sum(e.cost for e in edits), "".join(e.letter for e in edits), lines) == cheapest_by_hand(turns)


def held(search):
    nodes, todo = 0, [search.root]
    while todo:
        node = todo.pop()
        nodes, todo = nodes + len(node.edits), todo + node.kids
    return nodes


def test_only_unsettled_edits_are_held():
    search, most, settled = turn_repair.Survivors(), 0, 0
    for i in range(20_000):
        role = ("user", "assistant")[i % 2] if i % 7 else "user"
        search.step(turn_repair.Turn(i, role, "said.", ("blank" if i % 11 == 0 else None)))
        settled += sum(1 for _ in search.settled())
        most = max(most, held(search)) if i % 50 == 0 else most
    assert most < 60 and settled > 19_900
    assert settled + sum(1 for _ in search.end()) >= 20_000


def test_repair_of_odd_conversations(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Hello."), (1, 5, "user", "Bye."),
        (None, None, "user", "null turn."), (None, 3, "assistant", "yes!"), (2, 0, None, None), (3, 1, "user", "same."), (3, 1, "user", "same."),
        (3, 1, "assistant", "cut off"), (4, 0, "system", "s."), (4, 1, "user", "q?"), (4, 2, "assistant", "a. \n")]
    df = prepare(spark).createDataFrame([(*r, 1, "x") for r in rows], "conv_id int, turn int, role string, text string, conv int, first string")
    edits = turn_repair.repaired_turns(df)
    got = {r.conv_id: r.asDict() for r in turn_repair.summaries(edits).collect()}
    assert [(k, v["gaps"], v["blank"], v["duplicate"], v["truncated"], v["illegal"], v["cost"], v["audit"]) for k, v in sorted(got.items(), key=str)] == [
        (1, 2, 0, 1, 0, 1, 4, "KKDD"), (2, 0, 1, 0, 0, 0, 2, "D"), (3, 0, 0, 1, 1, 1, 6, "DDD"), (4, 0, 0, 0, 0, 0, 0, "KKK"), (None, 0, 0, 0, 0, 0, 0, "KK")]
    assert got[1]["repaired_sha256"] == hashlib.sha256(b"user:Hello.\nassistant:Hi.").hexdigest()
    assert got[None]["repaired_sha256"] == hashlib.sha256(b"user:null turn.\nassistant:yes!").hexdigest()
    assert [(r.place, r.edit, r.turn, r.fault) for r in edits.where("conv_id = 1").collect()] == [
        (0, "K", 0, None), (1, "K", 1, None), (2, "D", 2, "duplicate"), (3, "D", 5, None)]
    assert turn_repair.repaired_turns(df.limit(0)).collect() == [] == turn_repair.summaries(edits.limit(0)).collect()


def test_a_conversation_that_holds_most_rows(spark):
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["a.", "b?", "", f"t{i}.", f"c{i}"])) for i in range(6_000)]
    df = prepare(spark).createDataFrame(rows + [(i + 100, 0, "user", "x.") for i in range(50)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in turn_repair.summaries(turn_repair.repaired_turns(df)).collect()}
    seen, plain = set(), []
    for _, i, role, text in rows:
        plain.append((i, role, text, (role, text) in seen))
        seen.add((role, text))
    edits = list(turn_repair.repair(iter(plain)))
    assert got[7].audit == "".join(e.letter for e in edits) and got[7].cost == sum(e.cost for e in edits)
    assert len(got) == 51 and got[100].audit == "D"
