from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarterlode.operators import cases, meddra
from quarterlode.operators import entities as E
from quarterlode.operators import mapping as M
from quarterlode.operators.lookup import hot_hashes, is_small, join_on_key
from quarterlode.plans.silver import CODE_SETS, entity_table, refresh_silver, silver_drug, silver_tables
from quarterlode.session import materialise, new_path
from quarterlode.sources.tables import read_version

PT = "pt string, pt_code long, pt_soc_code long, nnmq_codes array<long>, smq_codes array<long>"
LLT = "llt_name string, llt_code long, pt_code long, pt_soc_code long, nnmq_codes array<long>, smq_codes array<long>"
REAC = "primaryid long, caseid long, pt string, drug_rec_act string, processing_time long, period string"


@pytest.mark.parametrize("small", [True, False, None])
def test_deleted_cases(spark, rows, small):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "primaryid long, caseid long")
    deleted = spark.createDataFrame([(10,), (10,), (None,), (99,)], "caseid long")
    assert rows(cases.deleted_ids(deleted)) == [(10,), (99,)]
    assert rows(cases.remove_deleted(fact, deleted, small), "primaryid") == [(2,), (3,)]
    audit = cases.removal_audit({"a": fact, "b": fact.where("caseid is null"), "c": fact.where("caseid = 10")}, deleted)
    assert rows(audit) == [("a", 4, 2, 2), ("b", 1, 1, 0), ("c", 2, 0, 2)]


def test_measured_bound(spark):
    df = spark.range(100)
    assert is_small(df) and not is_small(df, max_rows=99) and not is_small(df, max_bytes=100)
    assert is_small(df.where("id < 0"))


def test_rows_without_key_are_spread(spark):
    fact = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    lookup = spark.range(0, 10_000, 4).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_on_key(fact, lookup, "k", "left", small=False)
        assert joined.count() == 10_000 and joined.where("v = 'x'").count() == 2_500
        assert joined.columns == ["k", "id", "v"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_by_adaptive_execution(spark):
    """One case holds a third of the rows: its shuffle partition is read by several tasks."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16"}
    kept = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
        fact = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("primaryid"), hot.alias("caseid"))
        deleted = spark.range(0, 300_000, 7).select(F.col("id").alias("caseid"))
        out = cases.remove_deleted(fact, deleted, small=False)
        rows = out.collect()
        assert len(rows) == 300_000 - sum(1 for i in range(0, 300_000, 7) if i % 3)
        assert "skew=true" in out._jdf.queryExecution().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_hot_name_pair_stays_out_of_the_shuffle(spark, rows, no_auto_broadcast):
    """One pair of names, with a null in it, holds 90 % of the rows; the other pairs are shuffled."""
    n = 20_000
    hot = F.col("id") % 10 != 0
    drug = spark.range(n).select(
        "id", F.when(hot, F.lit("Hot")).otherwise(F.concat(F.lit("d"), F.col("id"))).alias("drugname"),
        F.when(~hot & (F.col("id") % 20 == 0), F.lit("AI")).alias("prod_ai"))
    pairs = drug.select("drugname", "prod_ai").distinct().where("drugname <> 'd10'")
    entities = pairs.select("drugname", "prod_ai", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("entity"))
    apart = E.attach_entities(drug, entities, small=False)
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "NestedLoop" not in plan
    assert apart.columns == ["id", "drugname", "prod_ai", "entity"]
    assert rows(apart) == rows(E.attach_entities(drug, entities, small=True))
    assert apart.count() == 2 * n - 1
    assert hot_hashes(drug.where("id < 0"), F.xxhash64("drugname")) == []
    assert rows(E.attach_entities(drug.where("id < 0"), entities, small=False)) == []


def test_hot_key_of_answers_stays_out_of_the_shuffle(spark, rows, no_auto_broadcast):
    key = F.when(F.col("id") % 10 != 0, F.lit("hot")).when(F.col("id") % 20 == 0, F.col("id").cast("string"))
    fact = spark.range(20_000).select("id", key.alias("entity"))
    answers = lambda keys: keys.where("entity <> '40'").withColumn("code", F.upper("entity"))
    apart = M.resolve_and_join_back(fact, "entity", answers, small=False)
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert rows(apart) == rows(M.resolve_and_join_back(fact, "entity", answers, small=True))
    assert apart.where("code = 'HOT'").count() == 18_000 and apart.where("code is null").count() == 1_001


def two_branch_coding(fact, pt, llt):
    """Coding by two branches and a union, as a check on the one-pass plan."""
    codes = list(meddra.CODES)
    low = fact.withColumn("pt", F.lower("pt")).join(pt, "pt", "left")
    done = low.where("pt_code is not null")
    rest = low.where("pt_code is null").drop(*codes)
    rest = rest.join(llt, rest["pt"] == llt["llt_name"], "left").drop("llt_name", "llt_code")
    columns = [*meddra.KEPT["reac"], *codes]
    return done.select(*columns).union(rest.select(*columns))


def test_term_coding(spark, rows):
    fact = spark.createDataFrame(
        [(i, i, t, None, 1, "24q1") for i, t in enumerate(["Pain", "FEVER", "old", "dup", "none", None, "empty"])], REAC)
    pt = spark.createDataFrame([("pain", 1, 10, [1], None), ("fever", 2, 20, None, [5]), ("empty", None, 9, [9], [9])], PT)
    llt = spark.createDataFrame([("old", 7, 3, 30, [3], [3]), ("dup", 8, 4, 40, None, None), ("dup", 9, 5, 50, None, None),
                                 ("pain", 1, 99, 99, [99], [99]), ("empty", 2, 6, 60, None, None)], LLT)
    out = meddra.code_terms(fact, "reac", pt, llt)
    assert out.columns == [*meddra.KEPT["reac"], *meddra.CODES]
    expect = two_branch_coding(fact, pt, llt)
    assert out.exceptAll(expect).count() == 0 and expect.exceptAll(out).count() == 0
    got = rows(out, "pt", "pt_code", "smq_codes")
    assert ("pain", 1, None) in got and ("empty", 6, None) in got and (None, None, None) in got
    assert sum(1 for g in got if g[0] == "dup") == 2
    indi = fact.select("primaryid", "caseid", F.lit(1).alias("indi_drug_seq"), F.col("pt").alias("indi_pt"),
                       "processing_time", "period", F.lit(0).alias("indi_pt_code"))
    coded = meddra.code_terms(indi, "indi", pt, llt)
    assert coded.columns == [*meddra.KEPT["indi"], "indi_pt_code", "indi_pt_soc_code", "nnmq_codes", "smq_codes"]
    with pytest.raises(ValueError):
        meddra.code_terms(fact, "demo", pt, llt)


def test_drug_terms(spark, rows):
    df = spark.createDataFrame(
        [(None, None), ("A(B)/C+D", None), ("Asp", "ACID"), ("asp", "acid"), (None, "X/Y")], "drugname string, prod_ai string")
    assert rows(E.drug_terms(df)) == sorted([
        (None, None, None), ("a(b)/c+d", None, "a ( b )  / c + d"), ("asp", "acid", "acid"),
        (None, "x/y", "x / y")], key=str)


def test_entities(spark, rows):
    vocabulary = spark.createDataFrame([("acid",), ("folic acid",), ("a,b c",), (None,), ("sodium",),
                                        ("sodium chloride 0.9 percent",)], "entity string")
    terms = spark.createDataFrame([("Folic".lower() + "\t acid tab acid",), ("sodium chloride 0.9 percent",), ("sodium chloride 0.9",), ("  lone ",), ("\t",), ("",), (None,), ("acidic",)], "term string")
    found = {r.term: r.entities for r in E.match_entities(terms, vocabulary).collect()}
    assert found == {"folic\t acid tab acid": ["acid", "folic acid"], "  lone ": ["lone"], "acidic": ["acidic"],
                     "sodium chloride 0.9 percent": ["sodium", "sodium chloride 0.9 percent"], "sodium chloride 0.9": ["sodium"]}
    text = spark.createDataFrame([(["a,b", "c \t d"],), (None,)], "e array<string>").select(E.entities_text(F.col("e")))
    assert [r[0] for r in text.collect()] == ["a b,c d", None]


@pytest.mark.parametrize("rows_sent", [None, 0])
def test_entities_against_brute_force(spark, monkeypatch, rows_sent):
    if rows_sent is not None:  # nothing is broadcast by hand
        monkeypatch.setattr("quarterlode.operators.lookup.MAX_ROWS", rows_sent)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(12)]
    texts = [rng.choices(words, weights=range(1, 13), k=rng.randint(1, 150)) for _ in range(60)] + [["w11"] * 100]
    entries = {" ".join(t[i : i + n]) for t in texts for n in (1, 2, 3, 9, 60) for i in (rng.randrange(len(t)),)}
    entries |= {" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(60)} | {"w1  w2", " w3", "absent", "w1 absent", ""}
    df = spark.createDataFrame([(i, rng.choice([" ", "  ", "\t"]).join(t)) for i, t in enumerate(texts)], "id int, text string")
    found = E.entities_by_key(df, "id", "text", spark.createDataFrame([(e,) for e in entries], "entity string"))
    got = {r.id: r.entities for r in found.collect()}
    for i, t in enumerate(texts):
        held = sorted(e for e in entries if e.split() and f" {e} " in f" {' '.join(t)} ")
        assert got[i] == held, (i, t)


def test_drug_rows_with_entities_and_codes(spark, rows):
    drug = spark.createDataFrame(
        [(1, 10, "ASP", "Acid"), (2, 20, "asp", "ACID"), (3, 30, None, None), (4, None, "new", None), (5, 99, "asp", "acid")],
        "primaryid long, caseid long, drugname string, prod_ai string")
    deleted = spark.createDataFrame([(99,)], "caseid long")
    vocabulary = spark.createDataFrame([("acid",)], "entity string")
    table = entity_table(drug.where("primaryid < 4"), lambda t: E.match_entities(t, vocabulary))
    assert rows(table) == [("asp", "acid", "acid", "acid"), (None, None, None, None)]
    mapping = spark.createDataFrame([("ACID", [("C1", "n", "t")], "s", 5)],
                                    "entity string, atc_code array<struct<id:string,name:string,class_type:string>>, strategy string, processing_time long")
    for small in (True, False):
        assert E.attach_entities(drug, table, small).count() == 5
    out = silver_drug(drug, deleted, table, mapping)
    assert rows(out, "primaryid", "entity", F.col("atc_code")[0]["id"], "strategy", "mapping_time") == [
        (1, "acid", "C1", "s", 5), (2, "acid", "C1", "s", 5), (3, None, None, None, None), (4, None, None, None, None)]


CODES = "array<struct<id:string,name:string,class_type:string>>"


@pytest.fixture()
def coded_drugs(spark):
    """Drug rows of three cases, one withdrawn, with entities that share codes, have none, or have two mappings."""
    drug = spark.createDataFrame(
        [(1, 10, 1, "ASP", "Acid", "24q1"), (2, 20, 1, "asp", None, "24q1"), (3, None, 1, "Two", None, None), (3, None, 1, "Two", None, None),
         (4, 99, 1, "asp", "acid", "24q1"), (5, 30, 1, None, None, "24q2"), (6, 30, 2, "bare", None, "24q2"), (7, 30, 3, "none", None, "24q2")],
        "primaryid long, caseid long, drug_seq long, drugname string, prod_ai string, period string")
    deleted = spark.createDataFrame([(99,)], "caseid long")
    entities = spark.createDataFrame(
        [("asp", "acid", "acid", "acid"), ("asp", None, "asp", "asp"), ("two", None, "two", "two"), ("two", None, "two", "acid"),
         ("bare", None, "bare", "bare"), ("none", None, "none", "none")],
        "drugname string, prod_ai string, term string, entity string")
    long = [(f"C{i}", None if i % 2 else "n", "t") for i in range(300)]
    mapping = spark.createDataFrame(
        [("ACID", long, "s", 5), ("asp", long, "s", 5), ("two", long[:1], "s", 6), ("Two", [], "m", 7), ("bare", None, "m", 8)],
        f"entity string, atc_code {CODES}, strategy string, processing_time long")
    return drug, deleted, entities, mapping


def test_stored_drug_rows_refer_to_codes(spark, rows, coded_drugs):
    """Rows hold a reference; each list of codes is stored once; both together are the rows in full."""
    drug, deleted, entities, mapping = coded_drugs
    made = silver_tables({"drug": drug}, deleted, None, None, entities, mapping)
    assert "atc_code" not in made["drug"].columns
    base = new_path(spark, "silver")
    refresh_silver(made, base)
    stored = {t: read_version(spark, f"{base}/{t}", df.schema) for t, df in made.items()}
    assert sorted(r.n for r in stored[CODE_SETS].select(F.size("atc_code").alias("n")).collect()) == [0, 1, 300]
    whole = E.with_codes(stored["drug"], stored[CODE_SETS])
    by_row = E.attach_entities(drug.where("caseid is null or caseid <> 99"), E.attach_codes(entities, mapping))
    assert sorted(whole.columns) == sorted(by_row.columns)
    assert rows(whole.select(by_row.columns)) == rows(by_row) and whole.count() == 11


def test_entity_list_holds_no_codes(spark, rows, coded_drugs, monkeypatch):
    """Codes meet the drug rows last, from a table with each list once, not by way of every name pair."""
    drug, deleted, entities, mapping = coded_drugs
    stored = {}

    def keep(df, label):
        stored[label] = materialise(df, label)
        return stored[label]

    monkeypatch.setattr("quarterlode.operators.entities.materialise", keep)
    out = silver_drug(drug, deleted, entities, mapping)
    assert "atc_code" not in stored["coded"].columns and stored["code_sets"].count() == 3
    by_row = E.attach_entities(drug.where("caseid is null or caseid <> 99"), E.attach_codes(entities, mapping))
    assert rows(out.select(by_row.columns)) == rows(by_row)


def test_rows_that_get_wide_answers_are_dealt_out(spark, rows):
    """One task's rows get a text of 20,000 characters each in several tasks; short answers move nothing."""
    fact = spark.range(0, 4_000, 1, 1).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("k"))
    tasks = {}
    for n in (2, 20_000):
        out = M.resolve_and_join_back(fact, "k", lambda keys, n=n: keys.where("k is not null").withColumn("text", F.repeat(F.lit("x"), n)))
        tasks[n] = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.count() == 4_000 and out.where(F.length("text") == n).count() == 2_666
    assert tasks[2] == 1 and tasks[20_000] >= 8


def test_model_hook(spark, rows):
    def load():
        return lambda text: [w for w in text.split() if w.isupper()]

    terms = spark.createDataFrame([("x B A B",), ("x B A B",), (" none ",), (" ",), (None,)], "term string")
    found = E.model_extractor(load)(terms)
    assert rows(found) == sorted([("x B A B", ["A", "B"]), (" none ", ["none"])], key=str)
