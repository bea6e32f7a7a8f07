"""Streaming flows: files to staging, staging to typed tables, distinct terms.

Every flow processes what has arrived and stops (``availableNow``); a later run
goes on from its checkpoint. The checkpoint lies beside the table it feeds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlode.operators.conform import ingest
from quarterlode.operators.entities import drug_terms
from quarterlode.functions.text import base_name, table_of
from quarterlode.operators.lookup import null_safe, sized_broadcast
from quarterlode.operators.repairs import correction_audit, known_repairs, rename_files, repair_files, repaired_headers
from quarterlode.schemas import DELETED_SCHEMA, TABLES
from quarterlode.session import materialise, new_path
from quarterlode.sources.archives import (
    BINARY_SCHEMA,
    DELETED,
    counted_lines,
    deleted_id,
    deleted_lines,
    in_deleted_list,
    read_chunks,
    read_lines,
)
from quarterlode.sources.delimited import parse_table
from quarterlode.sources.tables import load_periods, read_or_empty

UNREADABLE, AUDIT = "unreadable", "audit"  # stand beside the tables of a load
BUCKETS = 32  # of a table of distinct rows; a batch reads those that it touches
TERM_SCHEMA = "drugname string, prod_ai string, term string"


def append(stream: DataFrame, path: str) -> None:
    """Append a stream to a Parquet table; each input row lands once, also on restart."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hand what has arrived to ``write``, which must leave the same when a batch comes again."""
    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def arrivals(spark: SparkSession, folder: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """Stream of whole files whose name starts with ``prefix``, e.g. a table name.

    Folders of part files that Spark wrote under such a name count as files.
    """
    named = f"{{{prefix},file={prefix}}}*{suffix}"
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .load(f"{folder}/{named}")
    )


def raw_rows(files: DataFrame, table: str, processing_time: int, repairs: DataFrame | None = None) -> DataFrame:
    """Typed rows of one table from raw files or archives, stream or batch."""
    lines = repair_files(read_lines(files, (table,)), repairs)
    return parse_table(lines, table, processing_time)


def stage_table(spark: SparkSession, folder: str, table: str, path: str, processing_time: int) -> None:
    """Raw text files of one table to its staging table."""
    append(raw_rows(arrivals(spark, folder, table, ".txt"), table, processing_time), path)


def split_by_table(files: DataFrame) -> DataFrame:
    """Lines of files or archives, read once and stored by table, with the column ``table``.

    Lists of withdrawn cases are the table :data:`~quarterlode.sources.archives.DELETED`; an archive that cannot be
    read is a row of the table :data:`UNREADABLE`.
    """
    lines = counted_lines(read_chunks(files, (*TABLES, DELETED), strict=False))
    listed = in_deleted_list(F.col("path"), F.col("member"))
    table = F.when(F.col("error").isNotNull(), UNREADABLE).when(listed, DELETED).otherwise(table_of(rename_files(F.col("file")), TABLES))
    path = new_path(files.sparkSession, "lines")
    named = lines.withColumn("table", table).where("table is not null")
    named.write.partitionBy("table").parquet(path)
    return read_or_empty(files.sparkSession, path, named.schema)


def load_audit(lines: DataFrame, bad: DataFrame) -> DataFrame:
    """``file, kind, n, note`` of a load, from its stored lines and the archives that could not be read.

    The kinds of :func:`~quarterlode.operators.repairs.correction_audit`; ``no_number``, lines of lists of withdrawn
    cases without an id; and ``unreadable``, an archive that was left out, with the reason.
    """
    reports = lines.where(F.col("table") != DELETED)
    decoding = lines.groupBy("file").agg(F.sum("dropped").alias("dropped"), F.sum("latin").alias("latin")).where("dropped > 0 OR latin > 0")
    made = correction_audit(reports, known_repairs(lines.sparkSession), decoding=materialise(decoding, "decoding"))
    lists = lines.where((F.col("table") == DELETED) & (F.trim("line") != "") & deleted_id(F.col("line")).isNull())
    lists = lists.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select("file", F.lit("no_number").alias("kind"), "n")
    note = F.lit(None).cast("string").alias("note")
    left_out = bad.select(base_name(F.col("path")).alias("file"), F.lit("unreadable").alias("kind"), F.lit(1).cast("bigint").alias("n"), F.col("error").alias("note"))
    return made.unionByName(lists).select("file", "kind", "n", note).unionByName(left_out)


def arrived(files: DataFrame, processing_time: int) -> tuple[dict[str, DataFrame], DataFrame]:
    """Typed rows of all tables and ``deleted`` ids with their lines, and the audit of the load, from one read of the files.

    Of an archive that cannot be read to its end nothing is loaded; the others are, and the audit names it.
    """
    stored = split_by_table(files)
    bad = materialise(stored.where(F.col("table") == UNREADABLE).select("path", "error"), "unreadable")
    lines = stored.where(F.col("table") != UNREADABLE).join(sized_broadcast(bad.select("path")), "path", "left_anti")
    rows = {}
    for t in TABLES:
        own = lines.where(F.col("table") == t)
        rows[t] = parse_table(repair_files(own), t, processing_time, headers=repaired_headers(own.where("line_no = 0")))
    rows[DELETED] = deleted_lines(lines.where(F.col("table") == DELETED))
    return rows, load_audit(lines, bad)


def tables_of(files: DataFrame, processing_time: int) -> dict[str, DataFrame]:
    """Typed rows of all tables, and ``deleted`` ids with their lines; see :func:`arrived`."""
    return arrived(files, processing_time)[0]


def stage_archives(spark: SparkSession, folder: str, base: str, processing_time: int) -> None:
    """Archives to the staging tables of all seven tables, the deleted list and the audit, ``base/<table>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        made, audit = arrived(batch, processing_time)
        for name, rows in {**made, AUDIT: audit}.items():
            part = rows.withColumn("load", F.lit(f"load-{batch_id}"))
            (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(f"{base}/{name}"))

    each_batch(arrivals(spark, folder, suffix=".zip"), f"{base}/_checkpoint", write)


def deleted_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of withdrawn case ids from headerless lists."""
    return (
        spark.readStream.schema(DELETED_SCHEMA)
        .option("header", "false")
        .csv(f"{folder}/*delete*.txt")
    )


def stage_deleted(spark: SparkSession, folder: str, path: str) -> None:
    """Lists of withdrawn cases to their staging table."""
    append(deleted_stream(spark, folder), path)


def typed_stream(spark: SparkSession, path: str, schema: T.StructType | str, table: str) -> DataFrame:
    """Stream of a staging table through the ingest step."""
    return ingest(spark.readStream.schema(schema).parquet(path), table)


def load_typed(spark: SparkSession, source: str, schema: T.StructType | str, table: str, path: str) -> None:
    """Staging table to the typed table, by period; a batch is a load."""
    def write(batch: DataFrame, batch_id: int) -> None:
        load_periods(batch, path, f"stream-{batch_id}")

    each_batch(typed_stream(spark, source, schema, table), f"{path}/_checkpoint", write)


def held_rows(spark: SparkSession, path: str, schema: str, buckets: list[int], before: int) -> DataFrame:
    """Rows of earlier batches in the given buckets of a table that :func:`append_new_rows` writes; no other is read."""
    held = read_or_empty(spark, path, f"{schema}, bucket int, batch bigint")
    return held.where(F.col("bucket").isin(buckets) & (F.col("batch") < before))


def append_new_rows(
    stream: DataFrame, path: str, schema: str, derive: Callable[[DataFrame], DataFrame]
) -> None:
    """Append the distinct derived rows that the table does not hold yet.

    The table itself is the memory of what was seen, so there is no growing
    operator state, and a hot row is folded on the map side before it moves.
    Rows lie in :data:`BUCKETS` buckets by a hash of all columns; a batch reads those that
    its own rows fall into. Each batch owns one partition of each bucket and looks only at
    those of earlier batches: a batch that is run again writes the same rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = derive(batch).distinct()
        keys = found.columns
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        found = materialise(found.withColumn("bucket", bucket), "batch_rows")
        touched = [r.bucket for r in found.select("bucket").distinct().collect()]  # at most BUCKETS
        side = held_rows(spark, path, schema, touched, batch_id).select(*[F.col(c).alias(f"_{c}") for c in (*keys, "bucket")])
        same = null_safe([F.col(c) for c in (*keys, "bucket")], [F.col(f"_{c}") for c in (*keys, "bucket")])
        (
            found.join(side, same, "left_anti")
            .withColumn("batch", F.lit(batch_id).cast("bigint"))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "batch")
            .parquet(path)
        )

    each_batch(stream, f"{path}/_checkpoint", write)


def distinct_terms(spark: SparkSession, source: str, schema: T.StructType | str, path: str) -> None:
    """New name pairs of a growing drug table to the term table."""
    stream = spark.readStream.schema(schema).parquet(source).select("drugname", "prod_ai")
    append_new_rows(stream, path, TERM_SCHEMA, drug_terms)
