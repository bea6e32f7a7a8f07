from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlode.functions.casts import to_double, to_long, to_text
from quarterlode.operators import conform as C
from quarterlode.schemas import DROPS, SCHEMAS, TABLES, schema_of


def test_schemas():
    assert sorted(SCHEMAS) == sorted(TABLES) and len(TABLES) == 7
    assert {t: len(SCHEMAS[t]) for t in TABLES} == {
        "demo": 27, "drug": 22, "indi": 6, "outc": 5, "reac": 6, "rpsr": 5, "ther": 9}
    assert all(s.names[-2:] == ["processing_time", "period"] for s in SCHEMAS.values())
    with pytest.raises(ValueError, match="unknown table"):
        schema_of("nope")


@pytest.mark.parametrize("text,want", [
    ("123", 123), ("2.5", 2), ("3.5", 4), ("-2.5", -2), ("abc", None), ("", None), ("nan", None), (" 7 ", 7),
    ("9007199254740993", 9007199254740993), ("1e3", 1000), ("inf", None), ("1e300", None), (None, None)])
def test_to_long(spark, text, want):
    assert spark.range(1).select(to_long(F.lit(text).cast("string"))).first()[0] == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=50))
def test_casts_never_raise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    out = df.select("v", to_long(F.col("v")).alias("l"), to_double(F.col("v")).alias("d"), to_text(F.col("v")).alias("t"))
    for r in out.collect():
        assert r.d is None or r.d == r.d
        assert r.t == (None if r.v in ("", "None", "nan") else r.v)


def test_ingest_reac(spark):
    df = spark.createDataFrame(
        [("24q1", "123", "456", "None", "nan", 20240101, "junk"), ("24q1", "abc", "1", "HEADACHE", "x", 1, None)],
        "period string, primaryid string, caseid string, pt string, drug_rec_act string, processing_time bigint, _rescued_data string")
    out = C.ingest(df, "reac")
    assert out.schema == SCHEMAS["reac"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(123, 456, None, None, 20240101, "24q1"), (None, 1, "HEADACHE", "x", 1, "24q1")], key=str)


def test_ingest_mismatch(spark):
    df = spark.createDataFrame([(1, "x")], "primaryid bigint, unknown_col string")
    with pytest.raises(ValueError, match="columns of"):
        C.ingest(df, "reac")


def test_ingest_ther(spark):
    df = spark.createDataFrame(
        [(1, 100, 1, 20240101, 20240201, "3.5", "DAY", 20240101, "24q1")],
        "primaryid long, caseid long, dsg_drug_seq long, start_dt long, end_dt long, dur string, dur_cod string, "
        "processing_time long, period string")
    assert C.ingest(df, "ther").first().dur == 3.5


def test_names(spark):
    df = spark.createDataFrame([(1, 2, "FGN")], "PRIMARYID int, CASEID int, RPSR_COD string")
    assert C.lower_columns(df).columns == ["primaryid", "caseid", "rpsr_cod"]
    demo = spark.createDataFrame([tuple("abcd")], "foll_seq string, image string, death_dt string, confid string").withColumn("sex", F.lit("F"))
    assert C.drop_columns(demo, "demo").columns == ["sex"]
    assert len(DROPS["demo"]) == 4


def test_renames_and_collision(spark, rows):
    df = spark.createDataFrame([(1, None, 500), (2, 9, 501)], "isr int, primaryid int, case int")
    out = C.rename_columns(df, "drug")
    assert out.columns == ["primaryid", "caseid"]
    assert rows(out) == [(1, 500), (9, 501)]
    assert C.rename_columns(spark.createDataFrame([(1, 2)], "isr int, drug_seq int"), "indi").columns == ["primaryid", "indi_drug_seq"]
    assert C.rename_columns(spark.createDataFrame([(1, 2)], "isr int, drug_seq int"), "ther").columns == ["primaryid", "dsg_drug_seq"]


def test_added_only_if_absent(spark):
    df = spark.createDataFrame([(1, 7, "PAIN")], "primaryid long, caseid long, indi_pt string")
    assert C.add_missing_columns(df, "indi").first().caseid == 7
    bare = C.add_missing_columns(df.drop("caseid"), "indi")
    assert bare.schema["caseid"].dataType == T.LongType() and bare.first().caseid is None


def test_order_and_unknown_table(spark):
    df = spark.createDataFrame([(1, 2, 3)], "zzz int, caseid int, primaryid int")
    assert C.order_columns(df, "outc").columns == ["primaryid", "caseid", "zzz"]
    assert C.order_columns(df, "nope").columns == df.columns


def test_repair_columns(spark):
    df = spark.createDataFrame([("1", "2", "3", "PAIN", "x", 5, "24q1")],
                               "ISR string, DRUG_SEQ string, CASEID string, INDI_PT string, EXTRA string, PROCESSING_TIME int, PERIOD string")
    out = C.repair_columns(df, "indi")
    assert out.first().asDict() == {"primaryid": 1, "indi_drug_seq": 3 - 1, "caseid": 3, "indi_pt": "PAIN", "extra": "x",
                                    "processing_time": 5, "period": "24q1"}
    with pytest.raises(ValueError, match="indi_pt"):
        C.repair_columns(df.drop("INDI_PT"), "indi")


def test_schema_report(spark, rows):
    df = spark.createDataFrame([("1", 5), ("x", 6)], "primaryid string, caseid long")
    report = rows(C.schema_report(df, SCHEMAS["outc"]))
    assert ("primaryid", "wrong_type", "bigint", "string", 1) in report
    assert ("outc_cod", "missing", "string", None, 2) in report
    assert len(report) == 4
    assert C.schema_report(spark.createDataFrame([], SCHEMAS["outc"]), SCHEMAS["outc"]).count() == 0
