from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quarterlode.operators import mapping as M
from quarterlode.operators import vocabulary as K
from quarterlode.plans.silver import map_new_entities
from quarterlode.schemas import ENTITY_MAP_SCHEMA
from quarterlode.sources.tables import current_buckets, current_version, read_buckets, read_version, write_version

ANSWER = "rxcui string, page long, response string"
MAP_ROW = lambda e, id, s, t: (e, [(id, "n", "ATC1-4")], s, t)


def answers(spark, rows):
    return spark.createDataFrame([(a, p, r if isinstance(r, str) else json.dumps(r)) for a, p, r in rows], ANSWER)


def related(*groups):
    return {"allRelatedGroup": {"conceptGroup": [
        {"tty": t, "conceptProperties": [{"rxcui": i, "name": n, "tty": t} for i, n in c]} if c else {"tty": t} for t, c in groups]}}


def classes(*ids):
    return {"rxclassDrugInfoList": {"rxclassDrugInfo": [
        {"rxclassMinConceptItem": {"classId": i, "className": i.lower(), "classType": "ATC1-4"}} if i else {"other": 1} for i in ids]}}


HISTORY = {"rxcuiStatusHistory": {
    "metaData": {"status": "Remapped"},
    "definitionalFeatures": {"ingredientAndStrength": [
        {"activeIngredientRxcui": "i1", "activeIngredientName": "first"},
        {"activeIngredientRxcui": "i2", "activeIngredientName": "second"}]},
    "derivedConcepts": {
        "ingredientConcept": [{"ingredientRxcui": "i1", "ingredientName": "over"}, {"ingredientRxcui": "i3", "ingredientName": "third"}],
        "quantifiedConcept": [{"quantifiedRxcui": "q1", "quantifiedName": "qn", "quantifiedTTY": "IN", "quantifiedActive": "YES"}],
        "remappedConcept": [{"remappedRxCui": "r1", "remappedName": "rn", "remappedTTY": "SBD", "remappedActive": "NO"}],
        "scdConcept": {"scdConceptRxcui": "s1", "scdConceptName": "sn"},
        "qdFreeConcept": {"qdFreeRxcui": "f1", "qdFreeName": "fn"}}}}


def test_related(spark, rows):
    df = answers(spark, [
        ("c", 0, related(("IN", [("a", "A"), ("b", "B")]), ("BN", [("x", "X")]), ("PIN", [("a", "A2")]), ("PIN", []))),
        ("d", 0, "not json"), ("e", 0, {})])
    out = K.related_concepts(df)
    assert rows(out, "rxcui", "related_rxcui", "name", "tty") == [("c", "a", "A2", "PIN"), ("c", "b", "B", "IN")]
    assert [r.related_rxcui for r in out.orderBy("position").collect()] == ["a", "b"]
    assert K.related_concepts(df, None).count() == 3


def test_history(spark, rows):
    df = answers(spark, [("c", 0, HISTORY), ("bare", 0, {"rxcuiStatusHistory": {"metaData": {}}}),
                         ("none", 0, {"rxcuiStatusHistory": {"derivedConcepts": HISTORY["rxcuiStatusHistory"]["derivedConcepts"]}})])
    assert rows(K.history_status(df)) == [("bare", ""), ("c", "remapped")]
    found = K.history_ingredients(df)
    assert rows(found, "rxcui", "related_rxcui", "name") == [("c", "i1", "over"), ("c", "i2", "second"), ("c", "i3", "third")]
    assert [r.related_rxcui for r in found.orderBy("position").collect()] == ["i1", "i2", "i3"]
    assert rows(K.history_concepts(df), "related_rxcui", "name", "tty", "active") == [
        ("f1", "fn", "QD", None), ("q1", "qn", "IN", "YES"), ("r1", "rn", "SBD", "NO"), ("s1", "sn", "SCD", None)]


def test_ingredients_from_history(spark):
    history = answers(spark, [("c", 0, HISTORY)])
    relations = K.related_concepts(answers(spark, [
        ("s1", 0, related(("IN", [("i2", "via scd"), ("q1", "later")]))), ("f1", 0, related(("PIN", [("z", "via qd")]))),
        ("r1", 0, related(("IN", [("never", "never")])))]))
    out = K.ingredients_from_history(history, relations).orderBy("position")
    assert [(r.related_rxcui, r.name, r.source) for r in out.collect()] == [
        ("q1", "later", 0), ("i2", "via scd", 0), ("z", "via qd", 0), ("i1", "over", 1), ("i3", "third", 1)]


def test_classes(spark, rows):
    df = answers(spark, [("i", 0, classes("C1", None, "C2", "C1")), ("j", 0, "{}")])
    assert rows(K.drug_classes(df), "rxcui", "atc.id") == [("i", "C1"), ("i", "C1"), ("i", "C2")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def nearest_by_hand(terms, names):
    clean = lambda t: " ".join((t or "").lower().split())
    scored = {t: min((edits(clean(t), clean(n)), i) for i, n in names) for t in terms if clean(t)}
    return {t: (i, d) for t, (d, i) in scored.items()}


def test_nearest_concept_against_brute_force(spark):
    names = [("3", "aspirin"), ("1", "Aspirine"), ("2", "ibuprofen"), ("9", "x"), ("8", "a b"), ("7", "paracetamol"), ("6", "acid of paracetamol")]
    terms = ["paracetml", "aspirin 100 mg", "mg aspirin", "zzz qqq", "x" * 3_000, "ASPIRIN", "aspirine ", "asprin", "ibuprofan", "ibu", "y", "", None, "  ",
             "a  b", "ab", "aspirinée", "acid in paracetamols", "metfrmn zabcd"]
    want = nearest_by_hand(terms, names)
    assert want["paracetml"] == ("7", 2) and want["aspirin 100 mg"] == ("1", 7)
    given = spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(names, "rxcui string, name string")
    got = lambda **bound: {r.term: (r.rxcui, r.distance) for r in K.nearest_concept(*given, **bound).collect()}
    assert got() == want
    for most in (1, 2, 5):
        assert got(max_distance=most) == {t: v for t, v in want.items() if v[1] <= most}
    assert K.nearest_concept(given[0], given[1].limit(0)).collect() == []
    near = [("1", "metformin"), ("2", "metformax"), ("3", "metforal"), ("4", "zabcdefghijklmnop")]
    one = K.nearest_concept(spark.createDataFrame([("metfrmn zabcd",)], "term string"), spark.createDataFrame(near, "rxcui string, name string"))
    assert [(r.term, (r.rxcui, r.distance)) for r in one.collect()] == list(nearest_by_hand(["metfrmn zabcd"], near).items())


@pytest.mark.parametrize("rows_sent", [None, 0])
def test_nearest_concept_over_random_vocabularies(spark, monkeypatch, rows_sent):
    if rows_sent is not None:  # nothing is broadcast by hand
        monkeypatch.setattr("quarterlode.operators.lookup.MAX_ROWS", rows_sent)
    rng = random.Random(7)
    for letters, longest in (("ab", 9), ("abcdefgh", 30)):
        names = [(str(i), "".join(rng.choice(letters + " ") for _ in range(rng.randint(1, longest))).strip() or "a") for i in range(60)]
        terms = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest + 8))) for _ in range(60)}
        for _, n in names:
            cut = list(n)
            for _ in range(rng.randint(0, 4)):
                cut.insert(rng.randrange(len(cut) + 1), rng.choice(letters))
                del cut[rng.randrange(len(cut))]
            terms.add("".join(cut))
        found = K.nearest_concept(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame(names, "rxcui string, name string"))
        assert {r.term: (r.rxcui, r.distance) for r in found.collect()} == nearest_by_hand(terms, names)


@pytest.fixture()
def resolver(spark):
    concepts = spark.createDataFrame([("c1", "aspirin"), ("c2", "retired"), ("c3", "empty"), ("c4", "classless")], "rxcui string, name string")
    rel = answers(spark, [("c1", 0, related(("PIN", [("i9", "z")]), ("IN", [("i2", "y")]))), ("s1", 0, related(("IN", [("i2", "y")]))),
                          ("c4", 0, related(("IN", [("nope", "n")])))])
    history = answers(spark, [("c2", 0, HISTORY), ("c1", 0, HISTORY)])
    cls = answers(spark, [("i9", 0, classes("C1", "C2")), ("i2", 0, classes("C2")), ("i3", 0, classes("C3")), ("q1", 0, classes("Q"))])
    return K.vocabulary_resolver(concepts, rel, history, cls)


def test_whole_chain(spark, resolver):
    terms = spark.createDataFrame([(t,) for t in ("Aspirin", "retired", "empty", "classless", "unknown")], "entity string")
    out = {r.entity: [c.id for c in r.atc_code] for r in resolver(terms).collect()}
    # the nearest name has no bound: an unknown term is coded as its nearest one, here aspirin
    assert out == {"Aspirin": ["C1", "C2", "C2"], "retired": ["Q", "C2", "C3"], "unknown": ["C1", "C2", "C2"]}


def test_cascade_and_map(spark, resolver, rows, tmp_path):
    asked = []

    def model(entities):
        asked.append(sorted(r.entity for r in entities.collect()))
        table = spark.createDataFrame(
            [(f"{M.PROMPT_PREFIX}empty", "[{'id': 'M', 'name': 'm', 'class_type': 't'}]"), (f"{M.PROMPT_PREFIX}classles", "null")],
            "prompt string, response string")
        return M.answers_resolver(table)(entities)

    entities = spark.createDataFrame([("aspirin",), ("aspirin",), ("empty",), ("classles",), (None,)], "entity string")
    path = str(tmp_path / "map")
    left = map_new_entities(entities, path, [("vocabulary", resolver), ("model", model)], 42)
    assert rows(left) == [("classles",)] and asked == [["classles", "empty"]]
    table = read_buckets(spark, path, ENTITY_MAP_SCHEMA)
    assert rows(table, "entity", F.col("atc_code")[0]["id"], "strategy", "processing_time") == [
        ("aspirin", "C1", "vocabulary", 42), ("empty", "M", "model", 42)]
    map_new_entities(entities, path, [("vocabulary", resolver), ("model", model)], 43)
    assert asked[1] == ["classles"]
    assert rows(read_buckets(spark, path, ENTITY_MAP_SCHEMA)) == rows(table)
    with pytest.raises(ValueError):
        M.cascade(entities, [], 1)


def test_upsert(spark, rows, tmp_path):
    target = spark.createDataFrame([MAP_ROW("a", "1", "x", 1), MAP_ROW("b", "1", "x", 1)], ENTITY_MAP_SCHEMA)
    source = spark.createDataFrame([MAP_ROW("b", "2", "y", 2), MAP_ROW("b", "3", "z", 3), MAP_ROW("c", "4", "y", 2)], ENTITY_MAP_SCHEMA)
    want = [("a", "x", 1), ("b", "z", 3), ("c", "y", 2)]
    once = M.upsert(target, source)
    assert rows(once, "entity", "strategy", "processing_time") == want
    assert rows(M.upsert(once, source), "entity", "strategy", "processing_time") == want
    path = str(tmp_path / "t")
    assert read_version(spark, path, ENTITY_MAP_SCHEMA).count() == 0 and current_version(spark, path) is None
    assert [write_version(M.upsert(read_version(spark, path, ENTITY_MAP_SCHEMA), df), path) for df in (target, source, source)] == [1, 2, 3]
    assert rows(read_version(spark, path, ENTITY_MAP_SCHEMA), "entity", "strategy", "processing_time") == want
    # an attempt that died before its commit is not seen, and is written anew
    target.write.parquet(f"{path}/v000004")
    assert current_version(spark, path) == 3
    assert write_version(once, path) == 4
    assert rows(read_version(spark, path, ENTITY_MAP_SCHEMA), "entity", "strategy", "processing_time") == want


def test_json_and_prompt(spark):
    texts = ["[{'id': 'C1', 'name': 'n', 'class_type': 't'}]", "junk", None, "null", "[]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(M.atc_from_json(F.col("t")).alias("c"))
    got = [r.c for r in df.collect()]
    assert [c.id for c in got[0]] == ["C1"] and got[1:4] == [None, None, None] and got[4] == []
    assert df.select(M.atc_to_json(F.col("c"))).first()[0] == '[{"id":"C1","name":"n","class_type":"t"}]'
    assert spark.range(1).select(M.prompt(F.lit("x"))).first()[0].endswith("Drug or ingredient: x")


def test_resolve_each_key_once(spark, rows):
    seen = []

    def resolve(keys):
        seen.append(keys.count())
        return keys.withColumn("n", F.length("k"))

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bb"), (4, None)], "i int, k string")
    assert rows(M.resolve_and_join_back(df, "k", resolve), "i", "n") == [(1, 1), (2, 1), (3, 2), (4, None)]
    assert seen == [3]


def test_sample_and_batches(spark):
    df = spark.range(20_000).select(F.concat(F.lit("e"), F.col("id") % 10_000).alias("entity"))
    sample = M.keyed_sample(df, "entity", 10)
    n = sample.count()
    assert 1_600 < n < 2_400 and n == 2 * sample.distinct().count()
    assert sample.exceptAll(M.keyed_sample(df.repartition(7), "entity", 10)).count() == 0
    batches = df.select(M.keyed_bucket(F.col("entity"), 4).alias("b")).groupBy("b").count().collect()
    assert {r.b for r in batches} == {0, 1, 2, 3} and min(r["count"] for r in batches) > 4_000


def test_upsert_rewrites_only_touched_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "map")
    target = spark.createDataFrame([MAP_ROW(f"e{i}", "1", "x", 1) for i in range(200)], ENTITY_MAP_SCHEMA)
    source = spark.createDataFrame([MAP_ROW("e7", "2", "y", 2), MAP_ROW("e7", "3", "z", 3), MAP_ROW("new", "4", "y", 2)], ENTITY_MAP_SCHEMA)
    assert M.upsert_table(target.limit(0), path) == [] and read_buckets(spark, path, ENTITY_MAP_SCHEMA).count() == 0
    assert M.upsert_table(target, path, buckets=16) == list(range(16))
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "map" / "v000001").rglob("*.parquet")}
    touched = M.upsert_table(source, path, buckets=99)
    assert len(touched) in (1, 2) and current_buckets(spark, path)[1] == 16
    want = rows(M.upsert(target, source), "entity", "strategy", "processing_time")
    assert rows(read_buckets(spark, path, ENTITY_MAP_SCHEMA), "entity", "strategy", "processing_time") == want
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "map" / "v000001").rglob("*.parquet")} == before
    opened = {f.split("/v0")[1] for f in read_buckets(spark, path, ENTITY_MAP_SCHEMA).inputFiles()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in opened if f.startswith("00002")} == set(touched)
    # an attempt that died before its commit is not seen; run twice is run once
    target.write.parquet(f"{path}/v000003/bucket={touched[0]}")
    assert rows(read_buckets(spark, path, ENTITY_MAP_SCHEMA), "entity", "strategy", "processing_time") == want
    assert M.upsert_table(source, path) == touched
    assert rows(read_buckets(spark, path, ENTITY_MAP_SCHEMA), "entity", "strategy", "processing_time") == want
