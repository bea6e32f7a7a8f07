"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import difference, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test data is absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [
    "anti_deleted_reac", "removal_audit", "meddra_reac", "silver_indi", "line_repairs", "nullsafe_ci_join",
    "entity_match", "approx_term_top1"])
def test_query_without_any_broadcast(spark, con, name, monkeypatch):
    """The same rows when every lookup is beyond its bound and no join is broadcast."""
    monkeypatch.setattr("quarterlode.operators.lookup.MAX_ROWS", -1)
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in off:
        spark.conf.set(key, "-1")
    try:
        assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None
        if name == "meddra_reac":
            plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        for key in off:
            spark.conf.unset(key)


@pytest.mark.parametrize("name", ["resolve_atc", "resolve_join_back", "vocab_flatten_history", "vocab_history_ingredients"])
def test_no_join_compares_all_rows(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
