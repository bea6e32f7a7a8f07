"""Stages of the pipeline: what goes, what stays, and whole runs."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

import corpus_pipeline as P
from quarterlode.llm import containment, mixing, ngram_join, repetition

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test data is absent")


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, left = docs.columns, docs
    for name, stage in P.STAGES:
        before = left.cache()
        left = stage(spark, before, SF_DIR)
        ids = {r.doc_id for r in left.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}, name
        assert left.columns == names if name != "mixing" else left.columns == [*names, "copy"]
        if name == "quality_rules":
            assert ids == {r.doc_id for r in repetition.repetition(before).where("kept").collect()}
        if name == "near_duplicates":
            assert ids == {r.component_id for r in ngram_join.ngram_components(before).collect()}
        if name == "decontamination":
            bad = containment.contained(before, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
            assert ids == {r.doc_id for r in before.collect()} - {r.doc_id for r in bad.collect()}
        if name == "surrogates":
            assert left.count() == before.count()
            assert left.where("n_chars <> length(text)").count() == 0
        if name == "mixing":
            want = {(r.doc_id, r.copies) for r in mixing.fair_mix(before).where("copies > 0").collect()}
            assert {(r.doc_id, r["count"]) for r in left.groupBy("doc_id").count().collect()} == want


def test_run_is_the_stages(spark):
    first, second = (sorted((r.doc_id, r.copy, r.text) for r in P.run(spark, SF_DIR).collect()) for _ in range(2))
    assert first == second and first


def test_clean_documents_stay_and_planted_ones_go(spark):
    rng = random.Random(4)
    clean = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(60)) for _ in range(20)]
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = [clean[0], clean[1].replace(" ", "  "), f"{clean[2]} {items[0]} {clean[3]}", "short", "say it again " * 40, ""]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean + bad)] + [(99, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in docs.collect()) == list(range(20))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []
