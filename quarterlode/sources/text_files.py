"""Plain text files of any size as numbered lines, read split by split.

Spark's text reader cuts a file at line ends wherever a split begins, so no task holds a
whole file, but a line does not know its number. One pass counts the lines of each split;
sums over the splits before it give the number of its first line, and a second pass adds a
line's place in its split. Both passes run over one listing of the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterlode.functions.text import base_name, drop_bad_bytes, logical_file
from quarterlode.operators.lookup import sized_broadcast
from quarterlode.operators.repairs import FILES_WITH_BAD_BYTES
from quarterlode.session import materialise

MARK = "﻿"  # may begin a file and is no part of its first line


def _splits(raw: DataFrame) -> DataFrame:
    """Number of the first line of each split, and the header of its file."""
    counted = raw.groupBy("path", "start").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.min_by("line", "at").alias("head"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.select(
        F.col("path").alias("_path"), F.col("start").alias("_start"), "first_at",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_line"), F.first("head").over(whole).alias("header"))


def read_numbered(
    spark: SparkSession, path: str | Sequence[str], glob: str = "*.txt", lossy: Sequence[str] = FILES_WITH_BAD_BYTES,
) -> DataFrame:
    """Lines of the text files below ``path`` with their numbers: as from ``archives.read_lines``, and how each was decoded.

    ``path, member, file, line_no, header, line``; ``dropped`` bytes left out of the line, which only the files named
    in ``lossy`` may lose, and ``latin`` 1 if it was read as Latin-1, 0 else. Line 0 is the header. Empty lines count,
    empty files have none; lines end with a line feed, a carriage return, or both.
    """
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"))
    splits = sized_broadcast(materialise(_splits(raw), "splits"))
    placed = raw.join(splits, (F.col("path") == F.col("_path")) & (F.col("start") == F.col("_start")))
    parts = F.split(F.lower(F.replace("path", F.lit("="), F.lit("/"))), "/")
    loses = F.exists(parts, lambda p: p.isin([name.lower() for name in lossy]))

    def decoded(text):
        content = text.cast("binary")
        return (F.when(F.is_valid_utf8(text), text).when(loses, drop_bad_bytes(content)).otherwise(F.decode(content, "ISO-8859-1")))

    broken = ~F.is_valid_utf8("line")
    number = (F.col("first_line") + F.col("at") - F.col("first_at")).alias("line_no")
    lost = (F.octet_length("line") - F.octet_length(decoded(F.col("line")))).cast("bigint")
    header = F.regexp_replace(decoded(F.col("header")), f"^{MARK}", "")
    line = F.when(number == 0, header).otherwise(decoded(F.col("line")))
    member = base_name(F.col("path"))
    return placed.select(
        "path", member.alias("member"), F.coalesce(logical_file(F.col("path")), F.lower(member)).alias("file"), number,
        header.alias("header"), line.alias("line"), F.when(broken & loses, lost).otherwise(F.lit(0).cast("bigint")).alias("dropped"),
        (broken & ~loses).cast("bigint").alias("latin"))
