"""Queries that write tables or run streams, then read the table back."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings.file_queries import PARSED, PARSED_SQL, fact_columns, fact_sql
from quarterlode.bindings.registry import query
from quarterlode.functions.periods import is_current_era
from quarterlode.operators.conform import order_columns
from quarterlode.schemas import DELETED_SCHEMA, SCHEMAS
from quarterlode.session import new_path
from quarterlode.sources.tables import load_periods, read_or_empty
from quarterlode.streaming import flows

DEMO_SQL = "SELECT * FROM demo"


def _raw_files(spark, d, folder):
    """Raw delimited files of both eras, one folder of parts per file."""
    orders = V.table(spark, d, "orders").withColumns({
        "file": F.concat(F.lit("demo"), V.period("o_orderdate"), F.lit(".txt")),
        "day": V.yyyymmdd("o_orderdate"), "weight": F.floor("o_totalprice"),
        "current": is_current_era(V.later_year("o_orderdate"), F.quarter("o_orderdate")),
        "listed": V.period("o_orderdate").isin("12q4", "13q1"),
        "doubled": F.concat(F.col("o_orderstatus"), F.lit("$"), F.col("o_orderstatus")),
    })
    legacy = orders.where("not current").selectExpr(
        "file", "o_orderkey AS ISR", "o_custkey AS CASE", "'I' AS I_F_COD", "day AS EVENT_DT",
        "o_orderpriority AS REPT_COD", "o_orderstatus AS GNDR_COD", "weight AS WT", "'N' AS CONFID")
    current = orders.where("current").selectExpr(
        "file", "o_orderkey AS primaryid", "o_custkey AS caseid", "1 AS caseversion", "day AS event_dt",
        "doubled AS auth_num", "day AS ` rept_dt`", "o_orderpriority AS rept_cod", "o_orderstatus AS sex",
        "weight AS wt", "'note' AS site_note")
    for era in (legacy, current):
        (era.write.mode("append").partitionBy("file").options(header="true", sep="$", escape='"')
         .option("ignoreLeadingWhiteSpace", "false").csv(folder))


@query("stream_scan", PARSED_SQL)
def stream_scan(spark, d):
    folder, path = new_path(spark, "raw"), new_path(spark, "staging")
    _raw_files(spark, d, folder)
    flows.stage_table(spark, folder, "demo", path, V.RUN_TIME)
    return read_or_empty(spark, path, SCHEMAS["demo"]).select(*PARSED)


def _stream_fact(table, spark, d):
    folder, path = new_path(spark, "raw"), new_path(spark, "staging")
    names, older = V.raw_layout(table)
    rows = V.raw_facts(spark, d, table)
    for era, header in (("legacy", older), ("NOT legacy", names)):
        named = rows.where(era).select("file", *[F.col(n).alias(h) for n, h in zip(names, header, strict=True)])
        named.write.mode("append").partitionBy("file").options(header="true", sep="$", escape='"', emptyValue="").csv(folder)
    flows.stage_table(spark, folder, table, path, V.RUN_TIME)
    return fact_columns(read_or_empty(spark, path, SCHEMAS[table]), table)


for _table in V.RAW_COLUMNS:
    query(f"stream_scan_{_table}", fact_sql(_table))(partial(_stream_fact, _table))


@query("stream_deleted_scan", "SELECT caseid FROM deleted WHERE caseid IS NOT NULL")
def stream_deleted_scan(spark, d):
    folder, path = new_path(spark, "lists"), new_path(spark, "deleted")
    V.deleted(spark, d).where("caseid is not null").write.csv(f"{folder}/aDelete_delete24q1.txt")
    flows.stage_deleted(spark, folder, path)
    return read_or_empty(spark, path, DELETED_SCHEMA)


@query("stream_append_partitioned", PARSED_SQL.replace("parsed_demo", """(
    SELECT primaryid, caseid, CAST(7 AS BIGINT) AS caseversion, event_dt, 'A' || sex AS auth_num,
           CASE WHEN sex<>'P' THEN event_dt END AS rept_dt, rept_cod, sex, CAST(primaryid AS DOUBLE) + 0.5 AS wt,
           CAST(1700000000 AS BIGINT) AS processing_time, period FROM demo)"""))
def stream_append_partitioned(spark, d):
    staging, path = new_path(spark, "staging"), new_path(spark, "bronze")
    given = V.demo(spark, d).withColumns({
        "caseversion": F.lit("7.2"), "auth_num": F.concat(F.lit("A"), F.col("sex")),
        "rept_dt": F.when(F.col("sex") == "P", "nan").otherwise(F.col("event_dt").cast("string")),
        "wt": F.concat(F.col("primaryid"), F.lit(".5")), "processing_time": F.lit(str(V.RUN_TIME))})
    full = order_columns(given, "demo")
    absent = [c for c in SCHEMAS["demo"].names if c not in full.columns]
    text = full.select(*[F.col(c).cast("string").alias(c) for c in full.columns],
                       *[F.lit("None").alias(c) for c in absent], F.lit("junk").alias("_rescued_data"))
    text.write.parquet(staging)
    flows.load_typed(spark, staging, text.schema, "demo", path)
    return read_or_empty(spark, path, SCHEMAS["demo"]).select(*PARSED)


@query("stream_distinct_terms", "SELECT drugname, prod_ai, term FROM drug_names")
def stream_distinct_terms(spark, d):
    source, path = new_path(spark, "drug"), new_path(spark, "terms")
    drug = V.drug(spark, d).select("drugname", "prod_ai")
    # two arrivals with the same names: the second run adds nothing
    for _ in range(2):
        drug.write.mode("append").parquet(source)
        flows.distinct_terms(spark, source, drug.schema, path)
    return read_or_empty(spark, path, flows.TERM_SCHEMA)


@query("append_or_create", DEMO_SQL)
def append_or_create(spark, d):
    path = new_path(spark, "bronze")
    rows = V.demo(spark, d)
    early = F.col("period") < "11q1"
    # created by the first load, appended by the second, which runs twice; the third adds to periods that are there
    odd = F.col("primaryid") % 2 == 1
    for load, part in enumerate((rows.where(early), rows.where(~early & odd), rows.where(~early & odd), rows.where(~early & ~odd))):
        load_periods(part, path, min(load, 1) if load < 3 else 2)
    return read_or_empty(spark, path, rows.schema)


@query("read_or_empty", "SELECT primaryid, caseid, event_dt, rept_cod, sex, period FROM demo")
def read_or_empty_query(spark, d):
    rows = V.demo(spark, d)
    empty = read_or_empty(spark, new_path(spark, "absent"), rows.schema)
    return rows.unionByName(empty)


@query("table_scan", "SELECT primaryid, period FROM demo WHERE sex = 'F'")
def table_scan(spark, d):
    return V.demo(spark, d).where("sex = 'F'").select("primaryid", "period")

