"""Queries on raw files: scans, repairs, text sinks and file names."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings.registry import query
from quarterlode.functions import text as X
from quarterlode.operators import repairs as R
from quarterlode.operators.cases import remove_deleted
from quarterlode.operators.conform import enrich, ingest
from quarterlode.schemas import RESCUED, TABLES
from quarterlode.session import materialise, new_path
from quarterlode.sources.archives import DELETED, deleted_lines, read_lines
from quarterlode.sources.delimited import parse_table, read_corrected, write_corrected
from quarterlode.sources.text_files import read_numbered
from quarterlode.streaming.flows import arrived

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARSED = ("primaryid", "caseid", "caseversion", "event_dt", "auth_num", "rept_dt", "rept_cod", "sex", "wt",
          "processing_time", "period")
PARSED_SQL = f"SELECT {', '.join(PARSED)} FROM parsed_demo"


def _demo(spark, d, **more):
    """The raw lines of the demo table as typed rows."""
    raw = V.raw_lines(spark, d)
    return parse_table(R.repair_files(raw), "demo", V.RUN_TIME, headers=R.repaired_headers(raw), **more)


def _zip_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack each Arrow batch of lines into one archive, a member per file, plus unwanted members."""
    for batch in batches:
        files: dict[str, list[str]] = {}
        for file, header, line in zip(batch["file"], batch["header"], batch["line"], strict=True):
            files.setdefault(file.as_py(), [header.as_py()]).append(line.as_py())
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for file, lines in files.items():
                archive.writestr(f"ascii/{file.upper()}", "\r\n".join(lines) + "\r\n")
            archive.writestr("ascii/STAT.txt", "not a report file")
            archive.writestr("readme.pdf", "not a report file")
        yield pa.RecordBatch.from_pydict({"path": ["orders.zip"], "content": [packed.getvalue()]})


@query("zip_scan", "SELECT file, line FROM raw_lines")
def zip_scan(spark, d):
    archives = V.raw_lines(spark, d).select("file", "header", "line").mapInArrow(
        _zip_batches, "path string, content binary")
    return read_lines(archives, TABLES).where("line_no > 0").select("file", "line")


@query("delimited_scan", PARSED_SQL)
def delimited_scan(spark, d):
    return _demo(spark, d).select(*PARSED)


def fact_sql(table: str) -> str:
    """A fact table as its raw files give it back: empty texts are null."""
    columns = ", ".join(f"nullif({c}, '') AS {c}" if c in ("pt", "indi_pt", "drug_rec_act", "prod_ai", "drugname") else c
                        for c in V.RAW_COLUMNS[table])
    return f"SELECT {columns}, period, CAST({V.RUN_TIME} AS BIGINT) AS processing_time FROM {table}"


def fact_columns(rows, table: str):
    return rows.select(*V.RAW_COLUMNS[table], "period", "processing_time")


def _scan(table, spark, d):
    raw = V.raw_fact_lines(spark, d, table)
    return fact_columns(parse_table(R.repair_files(raw), table, V.RUN_TIME, headers=R.repaired_headers(raw)), table)


for _table in V.RAW_COLUMNS:
    query(f"scan_{_table}", fact_sql(_table))(partial(_scan, _table))


def _list_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack each Arrow batch of ids into an archive with a list of withdrawn cases."""
    for batch in batches:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            ids = [str(i) for i in batch["caseid"].to_pylist()]
            archive.writestr("DELETED/DELETE24Q1.TXT", "\r\n".join([*ids[::2], ""]))
            archive.writestr("deleted/cases.txt", "\n".join([*ids[1::2], "no id", ""]))
            archive.writestr("ascii/DEMO24Q1.txt", "primaryid$caseid\n1$2\n")
        yield pa.RecordBatch.from_pydict({"path": ["list.zip"], "content": [packed.getvalue()]})


@query("deleted_from_archives", "SELECT f.* FROM demo f WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.caseid = f.caseid)")
def deleted_from_archives(spark, d):
    """Lists of withdrawn cases are packed, read back and taken off the reports."""
    ids = V.deleted(spark, d).where("caseid is not null")
    archives = ids.mapInArrow(_list_batches, "path string, content binary")
    listed = deleted_lines(read_lines(archives, (DELETED,)))
    return remove_deleted(V.demo(spark, d), materialise(listed.select("caseid"), "deleted"))


@query("schema_drift_rescue", """
    SELECT o_orderkey AS primaryid, CASE WHEN header LIKE 'primaryid%' THEN 'note ' || o_orderstatus END AS site_note,
           CAST(CASE WHEN header LIKE 'primaryid%' THEN CASE WHEN file IN ('demo12q4.txt','demo13q1.txt') THEN 1 ELSE 2 END
                END AS BIGINT) AS n_rescued
    FROM orders JOIN raw_lines ON line_no = o_orderkey + 1""")
def schema_drift_rescue(spark, d):
    rows = _demo(spark, d, keep_rescued=True)
    return rows.select(
        "primaryid", F.col(RESCUED)["site_note"].alias("site_note"),
        F.when(F.col(RESCUED).isNotNull(), F.size(RESCUED)).cast("bigint").alias("n_rescued"))


# blanks at both ends, quotes, a backslash and the delimiter
AWKWARD = "  {0} \"q\" \\ $ a\tb  "


@query("csv_roundtrip", PARSED_SQL.replace("rept_cod", f"'{AWKWARD}'".replace("{0}", "' || rept_cod || '") + " AS rept_cod"))
def csv_roundtrip(spark, d):
    path = new_path(spark, "corrected")
    rows = _demo(spark, d)
    before, after = AWKWARD.split("{0}")
    write_corrected(rows.withColumn("rept_cod", F.concat(F.lit(before), "rept_cod", F.lit(after))), path)
    return ingest(read_corrected(spark, path, "demo"), "demo").select(*PARSED)


@query("enrich_period", """
    SELECT file, line_no, CAST(1700000000 AS BIGINT) AS processing_time, substr(file, 5, 4) AS period FROM raw_lines""")
def enrich_period(spark, d):
    lines = V.raw_lines(spark, d).select("file", "line_no")
    return enrich(lines, V.RUN_TIME, X.period_of_file(F.col("file")))


PATH_SQL = """'/in/' || source || '/' || CASE lang WHEN 'en' THEN 'demo' WHEN 'de' THEN 'ther' WHEN 'fr' THEN 'stat'
    ELSE 'note' END || '24Q' || CAST(1+doc_id%4 AS VARCHAR) || '.txt'"""


def _paths(spark, d):
    prefix = (F.when(F.col("lang") == "en", "demo").when(F.col("lang") == "de", "ther")
              .when(F.col("lang") == "fr", "stat").otherwise("note"))
    path = F.concat(F.lit("/in/"), F.col("source"), F.lit("/"), prefix, F.lit("24Q"),
                    (1 + F.col("doc_id") % 4).cast("string"), F.lit(".txt"))
    return V.table(spark, d, "documents").select("doc_id", path.alias("path"))


@query("table_dispatch", f"""
    SELECT doc_id, string_split(path, '/')[4] AS file,
           CASE WHEN string_split(path, '/')[4][1:4] IN ('demo','ther') THEN string_split(path, '/')[4][1:4] END AS table_name,
           '24q' || CAST(1+doc_id%4 AS VARCHAR) AS period
    FROM (SELECT doc_id, {PATH_SQL} AS path FROM documents)""")
def table_dispatch(spark, d):
    file = X.base_name(F.col("path"))
    return _paths(spark, d).select(
        "doc_id", file.alias("file"), X.table_of(file, TABLES).alias("table_name"),
        X.period_of_file(file).alias("period"))


@query("file_renames", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'demo18q1.txt' ELSE 'demo' || o_orderstatus || '.txt' END AS file
    FROM orders""")
def file_renames(spark, d):
    status = F.col("o_orderstatus")
    given = F.when(status == "P", F.lit("demo18q1_new.txt")).otherwise(F.concat(F.lit("demo"), status, F.lit(".txt")))
    return V.table(spark, d, "orders").select("o_orderkey", R.rename_files(given).alias("file"))


@query("encoding_cleanup", "SELECT doc_id, text FROM documents")
def encoding_cleanup(spark, d):
    # stray bytes around the text: lead bytes without a follower, followers without a lead
    damaged = F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-8"), F.unhex(F.lit("E282")))
    docs = V.table(spark, d, "documents")
    return docs.select("doc_id", X.drop_bad_bytes(damaged).alias("text"))


def _damaged_archive(rows: pa.Table) -> pa.Table:
    """An archive with the lines of one file, some of them in Latin-1, and another that is cut in half."""
    rows = rows.sort_by("line_no")
    file, header = rows["file"][0].as_py(), rows["header"][0].as_py()
    lines = [header.encode(), *(line.encode() + (b"\xe9" if n % 10 == 0 else b"") for n, line in zip(
        rows["line_no"].to_pylist(), rows["line"].to_pylist(), strict=True))]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(f"ascii/{file.upper()}", b"\r\n".join(lines))
        archive.writestr(f"deleted/delete{file[4:]}", "\n".join([*map(str, rows["line_no"].to_pylist()), "no id"]))
    whole = packed.getvalue()
    return pa.table({"path": [f"{file}.zip", f"cut_{file}.zip"], "content": pa.array([whole, whole[: len(whole) // 2]], pa.binary())})


@query("load_audit", """
    WITH files AS (SELECT file, header, count(*) FILTER (line_no % 10 = 0) AS latin FROM raw_lines GROUP BY ALL)
    SELECT file, kind, CAST(n AS BIGINT) AS n FROM (
        SELECT file, unnest(['line_repair','column_drop','column_rename','column_add','latin1']) AS kind,
               unnest([CASE WHEN file IN ('demo12q1.txt','demo12q4.txt','demo13q1.txt') THEN 1 ELSE 0 END,
                       CASE WHEN header LIKE 'ISR%' THEN 1 ELSE 0 END, 1, CASE WHEN header LIKE 'ISR%' THEN 7 ELSE 5 END, latin]) AS n FROM files
        UNION ALL SELECT 'delete' || file[5:], 'no_number', 1 FROM files
        UNION ALL SELECT 'cut_' || file || '.zip', 'unreadable', 1 FROM files) WHERE n > 0""")
def load_audit(spark, d):
    """Archives of every quarter and their cut copies are loaded; what the load corrected, lost and left out."""
    lines = V.raw_lines(spark, d).select("file", "line_no", "header", "line")
    archives = lines.groupBy("file").applyInArrow(_damaged_archive, "path string, content binary")
    return arrived(archives, V.RUN_TIME)[1].select("file", "kind", "n")


@query("text_scan", """
    SELECT file, row_number() OVER (PARTITION BY file ORDER BY line_no) AS line_no, header, line FROM raw_lines
    UNION ALL SELECT DISTINCT file, 0, header, header FROM raw_lines""")
def text_scan(spark, d):
    """Text files of every quarter, written and read back in splits."""
    path = new_path(spark, "text")
    lines = V.raw_lines(spark, d).select("file", "line_no", "line")
    heads = V.raw_headers(spark, d).select("file", "line_no", "line")
    written = lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "line_no")
    written.select("file", "line").write.partitionBy("file").text(path)
    return read_numbered(spark, path).select("file", "line_no", "header", "line")


@query("line_repairs", r"""
    SELECT doc_id, line_no, CAST(part - 1 AS INT) AS part, line FROM (
        SELECT doc_id, line_no, unnest(parts) AS line, generate_subscripts(parts, 1) AS part FROM (
            SELECT doc_id, line_no, string_split(CASE WHEN line_no = 0 AND doc_id IN (SELECT doc_id FROM labels)
                   THEN replace(line, '. ', chr(10)) ELSE line END, chr(10)) AS parts
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no
                  FROM documents)))""")
def line_repairs(spark, d):
    lines = V.table(spark, d, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id")).alias("file"), "doc_id",
        F.posexplode(F.split("text", "\n")).alias("n", "line")
    ).withColumn("line_no", F.col("n").cast("bigint")).drop("n")
    repairs = V.table(spark, d, "labels").select("doc_id").distinct().select(
        F.concat(F.lit("doc"), F.col("doc_id")).alias("file"), F.lit(0).cast("bigint").alias("line_no"),
        F.lit(". ").alias("old"), F.lit("\n").alias("new"))
    return R.repair_lines(lines, repairs).select("doc_id", "line_no", "part", "line")


@query("correction_audit", """
    SELECT file, kind, CAST(n AS BIGINT) AS n FROM (
        SELECT file, unnest(['line_repair','column_drop','column_rename','column_add']) AS kind,
               unnest([CASE WHEN file IN ('demo12q1.txt','demo12q4.txt','demo13q1.txt') THEN 1 ELSE 0 END,
                       CASE WHEN header LIKE 'ISR%' THEN 1 ELSE 0 END, 1,
                       CASE WHEN header LIKE 'ISR%' THEN 7 ELSE 5 END]) AS n
        FROM (SELECT DISTINCT file, header FROM raw_lines)) WHERE n > 0""")
def correction_audit(spark, d):
    return R.correction_audit(V.raw_headers(spark, d), R.known_repairs(spark))


@query("member_filter", """
    SELECT doc_id, name FROM (
        SELECT doc_id, CASE lang WHEN 'en' THEN 'DEMO24Q1.TXT' WHEN 'de' THEN '.demo24q1.txt' WHEN 'fr' THEN 'SIZE24q1.txt'
            ELSE 'drug24q1.' || CASE WHEN n_chars > 500 THEN 'txt' ELSE 'csv' END END AS name FROM documents)
    WHERE name IN ('DEMO24Q1.TXT', 'drug24q1.txt')""")
def member_filter(spark, d):
    ending = F.when(F.col("n_chars") > 500, F.lit("txt")).otherwise(F.lit("csv"))
    name = (F.when(F.col("lang") == "en", F.lit("DEMO24Q1.TXT")).when(F.col("lang") == "de", F.lit(".demo24q1.txt"))
            .when(F.col("lang") == "fr", F.lit("SIZE24q1.txt")).otherwise(F.concat(F.lit("drug24q1."), ending)))
    members = V.table(spark, d, "documents").select("doc_id", name.alias("name"))
    return members.where(X.is_report_member(F.col("name")))
