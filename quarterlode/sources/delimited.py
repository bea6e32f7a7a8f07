"""Delimited report files: header-driven mapping to the common schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlode.functions.casts import lenient
from quarterlode.functions.text import period_of_file, table_of
from quarterlode.operators.conform import check_schema
from quarterlode.operators.lookup import sized_broadcast
from quarterlode.schemas import DELIMITER, DROPS, RENAMES, RESCUED, TABLES, schema_of
from quarterlode.session import materialise

METADATA = ("processing_time", "period")
CSV_OPTIONS = {
    "sep": DELIMITER, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# One field: quoted (with doubled quotes inside) or everything up to a delimiter.
_QUOTED_FIELD = r'(?<=^|\$)(?:"(?:[^"]++|"")*+"[^$]*|[^$]*)'


def split_fields(line: Column) -> Column:
    """Fields of a delimited line, empty ones null; quotes are looked at only in lines that hold one."""
    plain = F.split(line, r"\$")
    quoted = F.transform(
        F.regexp_extract_all(line, F.lit(_QUOTED_FIELD), F.lit(0)),
        lambda f: F.when(
            f.rlike(r'^"(?:[^"]++|"")*+"'),
            F.replace(F.regexp_replace(f, r'(?s)^"((?:[^"]++|"")*+)"', "$1"), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )
    fields = F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)
    return F.transform(fields, lambda f: F.when(f != "", f))


def header_tokens(header: Column) -> Column:
    """Lower-cased column names of a header line."""
    return F.split(F.lower(header), r"\$")


def _older(table: str) -> dict[str, list[str]]:
    """Older names of each column of a table's schema."""
    found: dict[str, list[str]] = {}
    for old, new in RENAMES.get(table, {}).items():
        found.setdefault(new, []).append(old)
    return found


def _text_names(table: str) -> list[str]:
    return [n for n in schema_of(table).names if n not in METADATA]


def with_layout(df: DataFrame, table: str) -> DataFrame:
    """``df`` with what its ``header`` says.

    ``_at`` holds the place of each column's name and of its older ones, in schema order; ``_unknown`` the names
    that no rule of the table knows, and ``_unknown_at`` their places.
    """
    def place(name: Column) -> Column:
        return F.array_position("_tokens", name).cast("int") - 1

    names = [t for n in _text_names(table) for t in (n, *_older(table).get(n, ()))]
    known = {"", *schema_of(table).names, *RENAMES.get(table, {}), *DROPS.get(table, ())}
    tokens = df.withColumn("_tokens", header_tokens(F.col("header")))
    told = tokens.withColumn("_unknown", F.array_distinct(F.filter("_tokens", lambda t: ~t.isin(*known))))
    told = told.withColumns({"_at": F.array(*[place(F.lit(n)) for n in names]), "_unknown_at": F.transform("_unknown", place)})
    return told.drop("_tokens")


def data_lines(lines: DataFrame, table: str, headers: DataFrame | None) -> DataFrame:
    """Non-empty data lines of one table, split, with the layout of their header.

    Files of other tables, or without a period in their name, are left out.
    """
    file = F.col("file")
    own = lines.where(
        (table_of(file, TABLES) == table)
        & period_of_file(file).isNotNull()
        & (F.col("line_no") > 0)
        & (F.trim(F.col("line"), F.lit(" \t")) != ""))
    split = own.select("file", "header", split_fields(F.col("line")).alias("_fields"))
    if headers is None:
        return with_layout(split, table)
    distinct = headers.select("header").where("header is not null").distinct()
    layouts = materialise(with_layout(distinct, table), "layouts")
    return split.join(sized_broadcast(layouts), "header", "left")


def rescued() -> Column:
    """Values of columns that no rule of the table knows, by name; null if none."""
    values = F.transform("_unknown_at", lambda i: F.get("_fields", i))
    kept = F.map_filter(F.map_from_arrays("_unknown", values), lambda _, v: v.isNotNull())
    return F.when((F.size("_unknown") > 0) & (F.size(kept) > 0), kept)


def text_columns(table: str) -> list[Column]:
    """Columns of the table's schema over the split lines of :func:`data_lines`, still as text.

    A column comes from the name of its own or, failing that, from an older one.
    """
    found, slot = [], 0
    for name in _text_names(table):
        count = 1 + len(_older(table).get(name, ()))
        values = [F.get("_fields", F.get("_at", F.lit(i))) for i in range(slot, slot + count)]
        found.append(F.coalesce(*values).alias(name))
        slot += count
    return found


def parse_table(lines: DataFrame, table: str, processing_time: int, keep_rescued: bool = False, headers: DataFrame | None = None) -> DataFrame:
    """Repaired lines of one table as typed rows of the common schema.

    Both eras, any column order and surplus trailing fields are handled by the header of each line. With
    ``headers``, a frame that holds all headers of ``lines``, what a header says is worked out once for each
    distinct one and joined to its lines; without it, as in a stream, line by line.
    """
    extra = [rescued().alias(RESCUED)] if keep_rescued else []
    rows = data_lines(lines, table, headers)
    text = rows.select(
        *text_columns(table),
        F.lit(processing_time).cast("bigint").alias("processing_time"),
        period_of_file(F.col("file")).alias("period"),
        *extra,
    )
    schema = schema_of(table)
    typed = text.select(
        *[F.col(f.name) if f.name in METADATA else lenient(F.col(f.name), f.dataType).alias(f.name)
          for f in schema.fields],
        *[RESCUED for _ in extra],
    )
    return typed if keep_rescued else check_schema(typed, table)


def read_corrected(spark: SparkSession, path: str | Sequence[str], table: str) -> DataFrame:
    """Files in schema order with a header, as :func:`write_corrected` leaves them.

    Their layout is known, so Spark's splittable reader takes them.
    """
    text = T.StructType([T.StructField(n, T.StringType()) for n in schema_of(table).names])
    return spark.read.schema(text).options(header="true", **CSV_OPTIONS).csv(path)


def write_corrected(df: DataFrame, path: str) -> None:
    """Delimited text with a header."""
    df.write.mode("overwrite").options(header="true", emptyValue="", **CSV_OPTIONS).csv(path)
