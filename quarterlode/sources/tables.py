"""Parquet tables: read or empty, partitioned load, full refresh, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of literals, kept inside the JVM."""
    literals = F.array(*[F.struct(*map(F.lit, row)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(literals.cast(f"array<struct<{schema}>>")))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or an empty frame of its schema if it does not exist yet.

    Any other error is raised.
    """
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path).select(*empty.columns)
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
        return empty


def load_periods(df: DataFrame, path: str, load: str | int) -> None:
    """Append to a table partitioned by period and load.

    A load that runs again replaces what it wrote before; rows of a period that
    came with other loads stay. The rebalance hint gives each period files of
    even size and splits a period that dwarfs the others over several tasks.
    """
    (
        df.withColumn("load", F.lit(f"load-{load}"))
        .hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "load")
        .parquet(path)
    )


def distinct_periods(df: DataFrame) -> DataFrame:
    """Distinct periods of a table, nulls left out."""
    return df.select("period").where(F.col("period").isNotNull()).distinct()


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest committed version of a versioned table, ``None`` before the first."""
    commits = read_or_empty(spark, f"{path}/commits", "version bigint")
    return commits.agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Newest committed version of a table, or an empty frame."""
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    empty = spark.createDataFrame([], schema)
    return spark.read.schema(empty.schema).parquet(f"{path}/v{version:06d}").select(*empty.columns)


def write_version(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write a new version beside the one being read, then commit it.

    A version whose commit row is missing is never read, and is written anew by
    the next attempt.
    """
    spark = df.sparkSession
    version = (current_version(spark, path) or 0) + 1
    writer = df.hint("rebalance", *([partition_by] if partition_by else [])).write.mode("overwrite").option(
        "partitionOverwriteMode", "static")
    writer = writer.partitionBy(partition_by) if partition_by else writer
    writer.parquet(f"{path}/v{version:06d}")
    spark.range(version, version + 1, 1, 1).toDF("version").write.mode("append").parquet(f"{path}/commits")
    return version


def refresh_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a table as a whole, as a new version: a write that fails leaves the old one."""
    write_version(df, path, partition_by)


BUCKET_COMMITS = "bucket bigint, version bigint, buckets bigint"


def current_buckets(spark: SparkSession, path: str) -> tuple[dict[int, int], int | None]:
    """Newest committed version of each bucket of a table, and its number of buckets (``None`` before the first)."""
    commits = read_or_empty(spark, f"{path}/commits", BUCKET_COMMITS)
    rows = commits.groupBy("bucket").agg(F.max("version").alias("version"), F.max("buckets").alias("buckets")).collect()
    return {r["bucket"]: r["version"] for r in rows}, max((r["buckets"] for r in rows), default=None)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType | str, only: Sequence[int] | None = None) -> DataFrame:
    """Committed rows of a table in buckets, of all of them or of some; other buckets' files are not opened."""
    empty = spark.createDataFrame([], schema)
    current, _ = current_buckets(spark, path)
    paths = [f"{path}/v{v:06d}/bucket={b}" for b, v in sorted(current.items()) if only is None or b in set(only)]
    return spark.read.schema(empty.schema).parquet(*paths).select(*empty.columns) if paths else empty


def write_buckets(df: DataFrame, path: str, buckets: int, written: Sequence[int]) -> None:
    """Write whole buckets (those of column ``bucket``, listed) as new versions, then commit them in one row each.

    The files of all other buckets stay as they are. What is not committed is
    never read, and is written anew by the next attempt; one writer at a time.
    """
    if not written:
        return
    spark = df.sparkSession
    version = max(current_buckets(spark, path)[0].values(), default=0) + 1
    (df.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("bucket").parquet(f"{path}/v{version:06d}"))
    rows = [(b, version, buckets) for b in written]
    fixed_table(spark, rows, BUCKET_COMMITS).write.mode("append").parquet(f"{path}/commits")
