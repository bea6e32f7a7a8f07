from __future__ import annotations

import re
import zipfile

from pyspark.sql import functions as F

from quarterlode.operators import entities as E
from quarterlode.schemas import DELETED_SCHEMA, SCHEMAS
from quarterlode.sources.archives import binary_files
from quarterlode.sources.tables import load_periods, read_or_empty
from quarterlode.streaming import flows

DRUG = "primaryid long, drugname string, prod_ai string, period string"


def test_files_to_staging_to_typed(spark, rows, tmp_path):
    raw, staging, typed = tmp_path / "raw", str(tmp_path / "staging"), str(tmp_path / "typed")
    raw.mkdir()

    def run():
        flows.stage_table(spark, str(raw), "outc", staging, 5)
        flows.load_typed(spark, staging, SCHEMAS["outc"], "outc", typed)
        return rows(read_or_empty(spark, typed, SCHEMAS["outc"]))

    (raw / "outc11q2.txt").write_text("ISR$OUTC_COD$\n1$DE$\n2$nan$\n")
    (raw / "reac11q2.txt").write_text("ISR$PT$\n1$PAIN$\n")
    first = run()
    assert first == [(1, None, "DE", 5, "11q2"), (2, None, None, 5, "11q2")]
    (raw / "outc24q1.txt").write_text("primaryid$caseid$outc_cod$novel\n3$30$LT$x\n")
    assert run() == [*first, (3, 30, "LT", 5, "24q1")]
    assert run() == [*first, (3, 30, "LT", 5, "24q1")]
    assert (tmp_path / "typed" / "period=24q1").is_dir()
    batch = flows.raw_rows(binary_files(spark, str(raw)), "outc", 5)
    assert rows(batch) == run()


def test_archives_to_staging(spark, tmp_path):
    raw = tmp_path / "zips"
    raw.mkdir()
    with zipfile.ZipFile(raw / "faers_ascii_2024Q1.zip", "w") as z:
        z.writestr("ASCII/RPSR24Q1.txt", "primaryid$caseid$rpsr_cod\n1$2$FGN\n")
    flows.stage_archives(spark, str(raw), str(tmp_path / "out"), 1)
    assert read_or_empty(spark, str(tmp_path / "out/rpsr"), SCHEMAS["rpsr"]).first().rpsr_cod == "FGN"
    assert read_or_empty(spark, str(tmp_path / "out/demo"), SCHEMAS["demo"]).count() == 0


def test_deleted_lists(spark, rows, tmp_path):
    lists = tmp_path / "lists"
    lists.mkdir()
    (lists / "ADR_delete24q1.txt").write_text("12\n34\nbad\n")
    (lists / "demo24q1.txt").write_text("99\n")
    flows.stage_deleted(spark, str(lists), str(tmp_path / "out"))
    assert rows(read_or_empty(spark, str(tmp_path / "out"), DELETED_SCHEMA)) == [(12,), (34,), (None,)]


def test_distinct_terms_across_runs(spark, rows, tmp_path):
    source, path = str(tmp_path / "drug"), str(tmp_path / "terms")
    one = spark.createDataFrame([(1, "ASP", "Acid", "24q1"), (2, "asp", "ACID", "24q1"), (3, "Hot", None, "24q1")], DRUG)
    two = spark.createDataFrame([(4, "hot", None, "24q2"), (5, None, None, "24q2"), (6, None, None, "24q2")], DRUG)
    for part in (one, two, two):
        part.write.mode("append").parquet(source)
        flows.distinct_terms(spark, source, one.schema, path)
    got = rows(read_or_empty(spark, path, flows.TERM_SCHEMA))
    assert got == rows(E.drug_terms(one.unionByName(two))) and len(got) == 3


def test_a_batch_reads_the_buckets_it_touches(spark, rows, tmp_path, monkeypatch):
    source, path = str(tmp_path / "drug"), str(tmp_path / "terms")
    many = spark.createDataFrame([(i, f"name {i}", None, "24q1") for i in range(600)], DRUG)
    few = spark.createDataFrame([(1, "name 7", None, "24q2"), (2, "new", "one", "24q2")], DRUG)
    read, original = [], flows.held_rows

    def watched(*args):
        held = original(*args)
        plan = spark._jvm.PythonSQLUtils.explainString(held._jdf.queryExecution(), "formatted")
        filters = re.findall(r"PartitionFilters: (.*)", plan)
        read.append((len(args[3]), len({r.bucket for r in held.select("bucket").distinct().collect()}), [f for f in filters if "bucket" not in f]))
        return held

    monkeypatch.setattr(flows, "held_rows", watched)
    for part in (many, few):
        part.write.mode("append").parquet(source)
        flows.distinct_terms(spark, source, many.schema, path)
    assert read[0][0] == flows.BUCKETS and read[0][1:] == (0, [])
    assert read[1][0] == 2 and read[1][1] <= 2 and read[1][2] == []
    assert len(rows(read_or_empty(spark, path, flows.TERM_SCHEMA))) == 601


def test_batch_that_runs_again_writes_the_same(spark, rows, tmp_path):
    """The newest checkpoint entry is lost, as after a crash between write and commit."""
    source, path = str(tmp_path / "drug"), tmp_path / "terms"
    df = spark.createDataFrame([(1, "a", None, "24q1"), (2, "b", None, "24q1")], DRUG)
    df.write.parquet(source)
    flows.distinct_terms(spark, source, df.schema, str(path))
    commits = path / "_checkpoint" / "commits"
    for entry in [*commits.glob("[0-9]*"), *commits.glob(".[0-9]*.crc")]:
        entry.unlink()
    flows.distinct_terms(spark, source, df.schema, str(path))
    assert rows(read_or_empty(spark, str(path), flows.TERM_SCHEMA), "drugname") == [("a",), ("b",)]


def test_period_that_dwarfs_the_others_is_written_by_several_tasks(spark, tmp_path):
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        period = F.when(F.col("id") % 3 == 0, F.lit("24q1")).otherwise(F.concat(F.lit("1"), F.col("id") % 10, F.lit("q1")))
        df = spark.range(0, 300_000, 1, 8).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("x"), period.alias("period"))
        load_periods(df, str(tmp_path / "t"), 1)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    assert len(list((tmp_path / "t" / "period=24q1").rglob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300_000
