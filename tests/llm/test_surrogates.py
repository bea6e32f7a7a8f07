"""Surrogates against texts of known make-up, and formats that are nearly full."""

from __future__ import annotations

import itertools
import random
import string

import regex

from quarterlode.llm import pii
from quarterlode.llm.common import prepare

BAR = " ‖ "


def chosen(spark, units, key="k"):
    df = prepare(spark).createDataFrame(units, "kind string, unit string")
    return {(r.kind, r.unit): r.surrogate for r in pii.surrogates(df, key).collect()}


def test_nearly_full_formats_end(spark):
    mails = [f"{a}@{b}.co" for a, b in itertools.product(string.ascii_lowercase, repeat=2)]
    units = [("mail", m) for m in mails[:660]] + [("number", f"{i}") for i in range(10)] + [("card", f"4{i}") for i in range(10)]
    found = chosen(spark, units + units[:5])
    assert set(found) == set(units)
    for kind in ("mail", "number", "card"):
        own, given = {u for k, u in units if k == kind}, [s for (k, _), s in found.items() if k == kind]
        assert len(set(given)) == len(given) and not own & set(given)
    assert all(regex.fullmatch(r"[a-z]+@[a-z]\.co", s) for (k, _), s in found.items() if k == "mail")


def test_more_names_than_syllables_hold(spark, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", 1)
    units = [("female", f"name{i}".translate(str.maketrans(string.digits, "abcdefghij"))) for i in range(400)]
    found = chosen(spark, units)
    assert len(set(found.values())) == 400 and not set(found.values()) & {u for _, u in units}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def made(rng):
    """An entity: its kind, how it is written, and the pattern of what may stand in its place."""
    digits = lambda n: "".join(rng.choice(string.digits) for _ in range(n))
    kind = rng.choice(["mail", "phone", "address", "number", "card", "key", "name"])
    if kind == "mail":
        return kind, f"{rng.choice(['ann', 'bob.lee', 'x_y'])}@{rng.choice(['mail', 'post'])}.{rng.choice(['org', 'de'])}", r"[a-z._]+@[a-z]+\.(org|de)"
    if kind == "phone":
        return kind, f"+{rng.randint(1, 9)} {rng.randint(200, 204)} 555 {rng.randint(1000, 1004)}", r"\+\d \d{3} \d{3} \d{4}"
    if kind == "address":
        return kind, f"10.0.{rng.randint(0, 3)}.{rng.randint(1, 9)}", r"(\d{1,3}\.){3}\d{1,3}"
    if kind == "number":
        return kind, f"{rng.randint(100, 103)}-{rng.randint(10, 12)}-{rng.randint(1000, 1003)}", r"\d{3}-\d\d-\d{4}"
    if kind == "card":
        body = "4" + digits(14)
        body += next(d for d in string.digits if luhn(body + d))
        return kind, " ".join(body[i : i + 4] for i in range(0, 16, 4)) if rng.random() < 0.5 else body, r"\d{4}( ?)\d{4}\1\d{4}\1\d{4}"
    if kind == "key":
        return kind, "AKIA" + rng.choice(["ABCDEFGH", "STUVWXYZ"]) + digits(8), r"AKIA[A-Z]{8}\d{8}"
    return kind, f"{rng.choice(['Mr.', 'Mrs.', 'Herr'])} {rng.choice(['Anna', 'Otto', 'Ivo'])} {rng.choice(['Schmidt', 'Lopez'])}", r"(Mr\.|Mrs\.|Herr) \p{Lu}\p{L}+ \p{Lu}\p{L}+"


def same(kind, text):
    """What counts as one entity."""
    if kind == "name":
        return text.lower()
    return regex.sub(r"\D", "", text) if kind in ("phone", "number", "card") else text


def test_random_texts_of_known_parts(spark):
    rng = random.Random(8)
    filler = ["plain words here", "version 1.2.3 of 2024", "12345 items", "see chapter 4.", "", "naïve Ärger", "1111 2222 3333 4445", "a@b", "x=1; y=2"]
    texts, parts = [], []
    for _ in range(250):
        own = [made(rng) if rng.random() < 0.5 else (None, rng.choice(filler), None) for _ in range(rng.randint(0, 9))]
        parts.append(own)
        texts.append(BAR.join(p[1] for p in own))
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, None, 1), (None, texts[3], 1)]
    df = prepare(spark).createDataFrame(rows, "doc_id int, text string, kind int")
    got = {r.doc_id if r.text is not None else "null": r for r in pii.replace_entities(df, "key", count_col="n").collect() if r.doc_id is not None or r.text is None}
    assert got["null"].text is None and got["null"].n == 0
    given: dict[tuple, str] = {}
    for i, own in enumerate(parts):
        shown = got[i].text.split(BAR) if own else []
        assert len(shown) == len(own) and got[i].n == sum(kind is not None for kind, *_ in own)
        for (kind, text, pattern), new in zip(own, shown, strict=True):
            if kind is None:
                assert new == text
                continue
            assert regex.fullmatch(pattern, new) and same(kind, new) != same(kind, text), (text, new)
            assert kind != "card" or luhn(regex.sub(r"\D", "", new))
            assert given.setdefault((kind, same(kind, text)), same(kind, new)) == same(kind, new)
    # different entities stay different, and no surrogate is an entity that occurs
    assert len({(kind, new) for (kind, _), new in given.items()}) == len(given)
    assert not {(kind, new) for (kind, _), new in given.items()} & set(given)
