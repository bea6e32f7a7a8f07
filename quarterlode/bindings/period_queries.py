"""Queries on reporting periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings.registry import query
from quarterlode.bindings.view_sql import current_sql, period_sql
from quarterlode.functions import periods as P
from quarterlode.operators import period_sets as S
from quarterlode.sources.tables import distinct_periods

Y, Q = "year(o_orderdate)+12", "quarter(o_orderdate)"
AS_OF = "(SELECT max(o_orderdate) + INTERVAL 12 YEAR AS d FROM orders)"
KNOWN_SQL = f"""
    known AS (SELECT unnest(range(2004*4, CAST(year(d)*4 + greatest(quarter(d)-1, 1) - 1 AS BIGINT))) AS i FROM {AS_OF})"""
NAME_SQL = f"""CASE WHEN o_orderstatus='P' THEN 'readme.zip' WHEN {current_sql('o_orderdate')}
    THEN 'faers_ascii_' || CAST({Y} AS VARCHAR) || 'Q' || CAST({Q} AS VARCHAR) || '.zip'
    ELSE 'aers_ascii_' || CAST({Y} AS VARCHAR) || 'q' || CAST({Q} AS VARCHAR) || '.zip' END"""


def _orders(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate",
        V.later_year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))


def _later(date):
    return F.add_months(F.to_date(date), 12 * V.YEARS_LATER)


def _as_of(spark, d):
    return V.table(spark, d, "orders").agg(_later(F.max("o_orderdate")).alias("date"))


def _archives(spark, d):
    orders = _orders(spark, d)
    url = P.archive_url(F.col("y"), F.col("q"))
    name = F.when(F.col("o_orderstatus") == "P", F.lit("readme.zip")).otherwise(F.element_at(F.split(url, "/"), -1))
    return orders.select("o_orderkey", name.alias("name"))


@query("period_format", f"SELECT o_orderkey, {period_sql('o_orderdate')} AS period FROM orders")
def period_format(spark, d):
    return _orders(spark, d).select("o_orderkey", P.format_period(F.col("y"), F.col("q")).alias("period"))


@query("period_parse", f"""
    SELECT o_orderkey, CAST({Y} AS INT) AS year, CAST({Q} AS INT) AS quarter FROM orders""")
def period_parse(spark, d):
    p = F.col("period")
    return V.demo(spark, d).select(
        F.col("primaryid").alias("o_orderkey"), P.period_year(p).alias("year"), P.period_quarter(p).alias("quarter"))


@query("period_compare", f"""
    SELECT o_orderkey, a < b AS lt, a <= b AS le, a > b AS gt, a >= b AS ge, a = b AS eq, a <> b AS ne
    FROM (SELECT o_orderkey, ({Y})*10+{Q} AS a, 2010*10+o_orderkey%4+1 AS b FROM orders)""")
def period_compare(spark, d):
    a = P.order_key(F.col("y"), F.col("q"))
    b = P.order_key(F.lit(2010), F.col("o_orderkey") % 4 + 1)
    return _orders(spark, d).select(
        "o_orderkey", (a < b).alias("lt"), (a <= b).alias("le"), (a > b).alias("gt"),
        (a >= b).alias("ge"), (a == b).alias("eq"), (a != b).alias("ne"))


@query("period_next_prev", f"""
    SELECT o_orderkey, {period_sql('o_orderdate + INTERVAL 3 MONTH')} AS next_period,
           {period_sql('o_orderdate - INTERVAL 3 MONTH')} AS previous_period FROM orders""")
def period_next_prev(spark, d):
    nxt, prev = P.next_period(F.col("y"), F.col("q")), P.previous_period(F.col("y"), F.col("q"))
    return _orders(spark, d).select(
        "o_orderkey", P.format_period(nxt["year"], nxt["quarter"]).alias("next_period"),
        P.format_period(prev["year"], prev["quarter"]).alias("previous_period"))


@query("period_era", f"SELECT o_orderkey, {current_sql('o_orderdate')} AS current_era FROM orders")
def period_era(spark, d):
    return _orders(spark, d).select("o_orderkey", P.is_current_era(F.col("y"), F.col("q")).alias("current_era"))


@query("period_current", f"""
    SELECT o_orderkey, CAST({Y} AS INT) AS year, CAST({Q}-1 AS INT) AS quarter FROM orders""")
def period_current(spark, d):
    now = P.current_period(_later("o_orderdate"))
    return _orders(spark, d).select("o_orderkey", now["year"].alias("year"), now["quarter"].alias("quarter"))


@query("period_resolve", f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus<>'P' THEN CAST({Y} AS INT) END AS year,
           CASE WHEN o_orderstatus<>'P' THEN CAST({Q} AS INT) END AS quarter FROM orders""")
def period_resolve(spark, d):
    found = P.resolve_period(F.col("name"))
    return _archives(spark, d).select("o_orderkey", found["year"].alias("year"), found["quarter"].alias("quarter"))


@query("period_url", f"""
    SELECT o_orderkey, 'https://fis.fda.gov/content/Exports/' || CASE WHEN {current_sql('o_orderdate')}
        THEN 'faers_ascii_' || CAST({Y} AS VARCHAR) || 'Q' ELSE 'aers_ascii_' || CAST({Y} AS VARCHAR) || 'q' END
        || CAST({Q} AS VARCHAR) || '.zip' AS url FROM orders""")
def period_url(spark, d):
    return _orders(spark, d).select("o_orderkey", P.archive_url(F.col("y"), F.col("q")).alias("url"))


@query("all_periods", f"""
    WITH {KNOWN_SQL}
    SELECT printf('%02dq%d', CAST(i//4%100 AS INT), CAST(i%4+1 AS INT)) AS period, CAST(i//4 AS INT) AS year,
           CAST(i%4+1 AS INT) AS quarter, i > 2012*4+2 AS current_era FROM known""")
def all_periods(spark, d):
    return S.all_periods(_as_of(spark, d))


@query("missing_periods", f"""
    WITH {KNOWN_SQL}
    SELECT period FROM (SELECT printf('%02dq%d', CAST(i//4%100 AS INT), CAST(i%4+1 AS INT)) AS period FROM known)
    WHERE period NOT IN (SELECT {period_sql('o_orderdate')} FROM orders)""")
def missing_periods(spark, d):
    return S.missing_periods(S.all_periods(_as_of(spark, d)), V.demo(spark, d))


@query("missing_period_files", f"""
    WITH {KNOWN_SQL}
    SELECT period FROM (SELECT printf('%02dq%d', CAST(i//4%100 AS INT), CAST(i%4+1 AS INT)) AS period FROM known)
    WHERE period NOT IN (SELECT {period_sql('o_orderdate')} FROM orders WHERE o_orderstatus<>'P')""")
def missing_period_files(spark, d):
    return S.missing_periods(S.all_periods(_as_of(spark, d)), S.periods_of_archives(_archives(spark, d)))


@query("list_period_files", "SELECT 'orders.parquet' AS name, count(*) AS n_rows FROM orders")
def list_period_files(spark, d):
    """The files of a table by name, with the rows that they hold."""
    held = V.table(spark, d, "orders").select("o_orderkey", F.col("_metadata.file_path").alias("path"))
    name = F.regexp_extract("path", r"([^/]+\.parquet)(?:/part-[^/]*)?$", 1)
    return held.groupBy(name.alias("name")).agg(F.count("o_orderkey").alias("n_rows"))


@query("distinct_periods", f"SELECT DISTINCT {period_sql('o_orderdate')} AS period FROM orders")
def distinct(spark, d):
    return distinct_periods(V.demo(spark, d))


@query("periods_csv", """
    SELECT string_agg(period, ',' ORDER BY period) AS periods FROM (SELECT DISTINCT period FROM demo)""")
def periods_csv(spark, d):
    return S.periods_text(V.demo(spark, d))


@query("first_k_periods", f"""
    SELECT o_orderkey, {period_sql('o_orderdate')} || '|' || o_orderstatus AS first_two FROM orders""")
def first_k_periods(spark, d):
    listed = F.concat(F.lit(" "), F.col("period"), F.lit(" ,\t"), F.col("sex"), F.lit(",09q4 , 10q1"))
    return V.demo(spark, d).select(
        F.col("primaryid").alias("o_orderkey"), F.array_join(S.first_periods(listed, 2), "|").alias("first_two"))


@query("periods_to_fetch", f"""
    WITH {KNOWN_SQL},
      missing AS (SELECT printf('%02dq%d', CAST(i//4%100 AS INT), CAST(i%4+1 AS INT)) AS period, i FROM known
        WHERE printf('%02dq%d', CAST(i//4%100 AS INT), CAST(i%4+1 AS INT)) NOT IN (SELECT {period_sql('o_orderdate')} FROM orders WHERE o_orderstatus<>'P'))
    SELECT CAST(row_number() OVER (ORDER BY period) AS INT) AS place, period, 'https://fis.fda.gov/content/Exports/' || CASE WHEN i > 2012*4+2
        THEN 'faers_ascii_' || CAST(i//4 AS VARCHAR) || 'Q' ELSE 'aers_ascii_' || CAST(i//4 AS VARCHAR) || 'q' END || CAST(i%4+1 AS VARCHAR) || '.zip' AS url
    FROM missing QUALIFY place <= 6""")
def periods_to_fetch(spark, d):
    """Missing periods, as sorted text, the first six of it, and where they are."""
    return S.periods_to_fetch(S.all_periods(_as_of(spark, d)), S.periods_of_archives(_archives(spark, d)), 6)
