"""Lenient casts and null sentinels of the ingest step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value, case-sensitive.
NULL_TEXTS = ("None", "nan")


# What counts as a number. Texts are tested before they are cast, since a failed
# cast costs an exception per value.
WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def to_double(text: Column) -> Column:
    """Number or null; never an error, and never NaN."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole number, rounded half to even from any numeric text, or null.

    Plain digits do not take the detour over double, which would blur
    identifiers above 2^53.
    """
    return (
        F.when(text.rlike(WHOLE), text.try_cast("bigint"))
        .when(text.rlike(NUMBER), F.coalesce(
            text.try_cast("bigint"), F.bround(text.try_cast("double"), 0).try_cast("bigint")))
    )


def to_text(value: Column) -> Column:
    """Text with the null sentinels and the empty text made null."""
    text = value.cast("string")
    return F.when(~text.isin("", *NULL_TEXTS), text)


def null_sentinels(value: Column) -> Column:
    """Only the sentinel texts made null; other text as is."""
    return F.when(~value.isin(*NULL_TEXTS), value)


def lenient(value: Column, to: T.DataType, source: T.DataType | None = None) -> Column:
    """Cast by target type with the matching rule above.

    ``source`` is the type of the value, text if not given.
    """
    source = source or T.StringType()
    if isinstance(to, T.StringType):
        return to_text(value)
    if not isinstance(source, T.StringType):
        if source == to and not isinstance(to, T.DoubleType):
            return value
        number = F.when(~F.isnan(value), value) if isinstance(source, (T.DoubleType, T.FloatType)) else value
        if isinstance(to, T.LongType) and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
            number = F.bround(number, 0)
        return number.try_cast(to)
    if isinstance(to, T.LongType):
        return to_long(value)
    if isinstance(to, T.DoubleType):
        return to_double(value)
    return value.try_cast(to)
