"""Queries on column names, types, nulls and schema checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings.registry import query
from quarterlode.functions.casts import to_double, to_long
from quarterlode.operators import conform as C
from quarterlode.schemas import SCHEMAS


def _legacy(spark, d):
    """Orders under the upper-case names of the legacy era."""
    return V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ISR"), F.col("o_custkey").alias("CASE"), F.col("o_orderstatus").alias("GNDR_COD"),
        F.col("o_orderpriority").alias("FOLL_SEQ"), F.lit("N").alias("CONFID"), F.col("o_totalprice").alias("WT"))


@query("lower_columns", """
    SELECT o_orderkey AS isr, o_custkey AS "case", o_orderstatus AS gndr_cod, o_orderpriority AS foll_seq,
           'N' AS confid, o_totalprice AS wt FROM orders""")
def lower_columns(spark, d):
    return C.lower_columns(_legacy(spark, d))


@query("drop_columns", """
    SELECT o_orderkey AS isr, o_custkey AS "case", o_orderstatus AS gndr_cod, o_totalprice AS wt FROM orders""")
def drop_columns(spark, d):
    return C.drop_columns(C.lower_columns(_legacy(spark, d)), "demo")


@query("rename_columns", """
    SELECT o_orderkey AS primaryid, coalesce(CASE WHEN o_orderstatus='P' THEN o_custkey+1 END, o_custkey) AS caseid,
           o_orderstatus AS sex, o_totalprice AS wt FROM orders""")
def rename_columns(spark, d):
    legacy = C.drop_columns(C.lower_columns(_legacy(spark, d)), "demo")
    both = legacy.withColumn("caseid", F.when(F.col("gndr_cod") == "P", F.col("case") + 1))
    return C.rename_columns(both, "demo")


@query("add_missing_columns", """
    SELECT event_id AS primaryid, event_type AS pt, CAST(NULL AS BIGINT) IS NULL AS caseid_is_null,
           user_id AS drug_rec_act FROM events""")
def add_missing_columns(spark, d):
    given = V.table(spark, d, "events").select(
        F.col("event_id").alias("primaryid"), F.col("event_type").alias("pt"), F.col("user_id").alias("drug_rec_act"))
    added = C.add_missing_columns(given, "reac")
    return added.select("primaryid", "pt", F.col("caseid").isNull().alias("caseid_is_null"), "drug_rec_act")


TEXT_SQL = """CASE l_returnflag WHEN 'A' THEN CAST(l_orderkey AS VARCHAR) || '.5'
    WHEN 'R' THEN CASE WHEN l_linestatus='F' THEN 'nan' ELSE l_returnflag || CAST(l_orderkey AS VARCHAR) END
    ELSE ' ' || CAST(l_partkey AS VARCHAR) || ' ' END"""


def _number_text():
    key, flag = F.col("l_orderkey").cast("string"), F.col("l_returnflag")
    broken = F.when(F.col("l_linestatus") == "F", F.lit("nan")).otherwise(F.concat(flag, key))
    return (F.when(flag == "A", F.concat(key, F.lit(".5"))).when(flag == "R", broken)
            .otherwise(F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" "))))


@query("lenient_casts", f"""
    SELECT l_orderkey, l_linenumber, raw, TRY_CAST(round_even(d, 0) AS BIGINT) AS as_long, d AS as_double
    FROM (SELECT l_orderkey, l_linenumber, raw, CASE WHEN NOT isnan(TRY_CAST(raw AS DOUBLE)) THEN TRY_CAST(raw AS DOUBLE) END AS d
          FROM (SELECT l_orderkey, l_linenumber, {TEXT_SQL} AS raw FROM lineitem))""")
def lenient_casts(spark, d):
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _number_text().alias("raw"))
    return lines.select("*", to_long(F.col("raw")).alias("as_long"), to_double(F.col("raw")).alias("as_double"))


@query("null_sentinels", """
    SELECT event_id, CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN NULL WHEN 'error' THEN 'NONE'
           ELSE event_type END AS pt, CASE WHEN event_type<>'signup' THEN value END AS dur FROM events""")
def null_sentinels(spark, d):
    kind = F.col("event_type")
    text = (F.when(kind == "click", "None").when(kind == "view", "nan").when(kind == "error", "NONE").otherwise(kind))
    number = F.when(kind != "signup", F.col("value")).otherwise(F.lit(float("nan")))
    return C.clear_sentinels(V.table(spark, d, "events").select("event_id", text.alias("pt"), number.alias("dur")))


@query("order_columns", "SELECT primaryid, caseid, outc_cod, processing_time, period, 'x' AS extra FROM outc")
def order_columns(spark, d):
    shuffled = V.outc(spark, d).select(F.lit("x").alias("extra"), "period", "outc_cod", "processing_time", "caseid", "primaryid")
    return C.order_columns(shuffled, "outc")


@query("schema_conformance", "SELECT primaryid, caseid, outc_cod, processing_time, period FROM outc")
def schema_conformance(spark, d):
    text = V.outc(spark, d).select(*[F.col(c).cast("string").alias(c) for c in ("period", "outc_cod", "caseid", "primaryid", "processing_time")])
    return C.ingest(text, "outc")


@query("schema_diff_report", """
    SELECT 'caseid' AS column_name, 'missing' AS issue, 'bigint' AS expected, '' AS actual, count(*) AS n_unfit FROM orders
    UNION ALL SELECT 'processing_time', 'missing', 'bigint', '', count(*) FROM orders
    UNION ALL SELECT 'primaryid', 'wrong_type', 'bigint', 'string', count(*) FILTER (o_orderstatus='P') FROM orders""")
def schema_diff_report(spark, d):
    key = F.col("o_orderkey").cast("string")
    given = V.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("P"), key)).otherwise(key).alias("primaryid"),
        F.col("o_orderpriority").alias("outc_cod"), V.period("o_orderdate").alias("period"),
        F.col("o_totalprice").alias("extra"))
    return C.schema_report(given, SCHEMAS["outc"]).withColumn("actual", F.coalesce("actual", F.lit("")))
