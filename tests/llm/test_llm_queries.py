"""Queries of the package against their SQL, and the pipeline against its parts."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import difference, duck

from quarterlode.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test data is absent")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(spark, duck(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_per_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()]
    want = [r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)


def test_each_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_no_python_in_native_plans(spark):
    for name in ("op6_chat_format", "op9_surrogates"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Arrow", "Pandas", "Python"))
