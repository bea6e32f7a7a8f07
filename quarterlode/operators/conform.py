"""Bringing named columns to the common schema: names, types, nulls and order."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlode.functions.casts import lenient, null_sentinels
from quarterlode.schemas import ADDS, DROPS, RENAMES, RESCUED, SCHEMAS, schema_of, type_of


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def drop_columns(df: DataFrame, table: str) -> DataFrame:
    """Drop the columns that the common schema gave up, where present."""
    return df.drop(*DROPS.get(table, ()))


def rename_columns(df: DataFrame, table: str) -> DataFrame:
    """Apply the older names; where both names exist the values are coalesced."""
    renames = {old: new for old, new in RENAMES.get(table, {}).items() if old in df.columns}
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(renames.get(c, c), []).append(c)
    # the value under the common name goes first
    return df.select(*[
        F.coalesce(*sorted(olds, key=lambda o, n=name: o != n)).alias(name)
        if len(olds) > 1 else F.col(olds[0]).alias(name)
        for name, olds in sources.items()
    ])


def add_missing_columns(df: DataFrame, table: str) -> DataFrame:
    """Add the columns an era lacks as typed nulls, only if absent."""
    absent = [c for c in ADDS.get(table, ()) if c not in df.columns]
    return df.select("*", *[F.lit(None).cast(type_of(c)).alias(c) for c in absent])


def cast_columns(df: DataFrame) -> DataFrame:
    """Cast every known column leniently; unknown columns pass through."""
    return df.select(*[
        F.col(f.name) if type_of(f.name) is None
        else lenient(F.col(f.name), type_of(f.name), f.dataType).alias(f.name)
        for f in df.schema.fields
    ])


def clear_sentinels(df: DataFrame) -> DataFrame:
    """Null out the sentinel texts and NaN in all columns."""
    def clean(f: T.StructField):
        if isinstance(f.dataType, T.StringType):
            return null_sentinels(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        return F.col(f.name)

    return df.select(*map(clean, df.schema.fields))


def order_columns(df: DataFrame, table: str) -> DataFrame:
    """Schema order, extra columns last; an unknown table is left as is."""
    if table not in SCHEMAS:
        return df
    known = [c for c in SCHEMAS[table].names if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def check_schema(df: DataFrame, table: str) -> DataFrame:
    """Pass the frame on if names, order and types are exact, else ``ValueError``."""
    expected = [(f.name, f.dataType) for f in schema_of(table).fields]
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    if expected != actual:
        raise ValueError(f"columns of {table} are {actual}, not {expected}")
    return df


def schema_differences(df: DataFrame, expected: T.StructType) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """Missing columns, and wrong types as ``name -> (expected, actual)``; extras are allowed."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in actual]
    wrong = {
        f.name: (f.dataType.simpleString(), actual[f.name])
        for f in expected.fields
        if f.name in actual and actual[f.name] != f.dataType.simpleString()
    }
    return missing, wrong


def check_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Pass the frame on if it holds at least the expected columns, else ``ValueError``."""
    missing, wrong = schema_differences(df, expected)
    if missing or wrong:
        raise ValueError(f"columns absent: {missing}; of another type: {wrong}")
    return df


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per difference, with the number of values that do not fit the type.

    All columns are counted in one aggregate pass, then turned into rows.
    """
    missing, wrong = schema_differences(df, expected)
    types = {f.name: f.dataType for f in expected.fields}

    def unfit(name: str):
        value = F.col(name)
        lost = value.isNotNull() & lenient(value, types[name], df.schema[name].dataType).isNull()
        return F.count_if(lost).alias(name)

    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[unfit(c) for c in wrong])
    row = "struct<column_name:string,issue:string,expected:string,actual:string,n_unfit:bigint>"
    rows = [
        F.struct(F.lit(c), F.lit("missing"), F.lit(types[c].simpleString()),
                 F.lit(None).cast("string"), F.col("_rows")).cast(row)
        for c in missing
    ] + [
        F.struct(F.lit(c), F.lit("wrong_type"), F.lit(e), F.lit(a), F.col(c)).cast(row)
        for c, (e, a) in wrong.items()
    ]
    listed = F.array(*rows) if rows else F.array().cast(f"array<{row}>")
    return counted.select(F.inline(listed))


def repair_columns(df: DataFrame, table: str) -> DataFrame:
    """The column part of the repair step: names, drops, renames, adds and casts."""
    for step in (drop_columns, rename_columns, add_missing_columns):
        df = step(lower_columns(df), table)
    return check_columns(cast_columns(df), schema_of(table))


def ingest(df: DataFrame, table: str) -> DataFrame:
    """The ingest step: casts, nulls, order and the strict check. Works on streams too."""
    df = clear_sentinels(cast_columns(df.drop(RESCUED)))
    return check_schema(order_columns(df, table), table)


def enrich(df: DataFrame, processing_time: int, period) -> DataFrame:
    """Add the run's epoch second and the period."""
    return df.withColumns({
        "processing_time": F.lit(processing_time).cast("bigint"),
        "period": period,
    })
