"""Reporting periods (year and quarter) as column expressions.

A period travels as text ``yyqN`` or as the two integers. Nothing here needs a
join or a shuffle. The calendar date is always an argument, never the clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The era change, the first published quarter, the archive address.
FIRST_PERIOD = (2004, 1)
LAST_LEGACY_PERIOD = (2012, 3)
ARCHIVE_URL = "https://fis.fda.gov/content/Exports/%s_ascii_%d%s%d.zip"
LEGACY_PREFIX, CURRENT_PREFIX = "aers", "faers"
NAME_PATTERN = r"(\d{4})[qQ](\d)"


def quarter_index(year: Column | int, quarter: Column | int) -> Column | int:
    """Position of a quarter on a gapless axis."""
    return year * 4 + quarter - 1


def format_period(year: Column, quarter: Column) -> Column:
    """``yyqN`` text of a period."""
    yy = F.lpad((year % 100).cast("string"), 2, "0")
    return F.concat(yy, F.lit("q"), quarter.cast("string"))


def format_index(index: Column) -> Column:
    """``yyqN`` text of a position made by :func:`quarter_index`."""
    return format_period(F.floor(index / 4), index % 4 + 1)


def period_year(period: Column) -> Column:
    """Year of a ``yyqN`` text; the century is always 20."""
    return F.concat(F.lit("20"), F.split(period, "q").getItem(0)).try_cast("int")


def period_quarter(period: Column) -> Column:
    """Quarter of a ``yyqN`` text."""
    return F.get(F.split(period, "q"), F.lit(1)).try_cast("int")


def order_key(year: Column, quarter: Column) -> Column:
    """Integer that sorts like the period, also for quarter 0 of a year."""
    return year * 10 + quarter


def shifted_period(year: Column, quarter: Column, by: int) -> Column:
    """Struct of the period so many quarters later."""
    index = quarter_index(year, quarter) + by
    return F.struct(F.floor(index / 4).cast("int").alias("year"), (F.pmod(index, F.lit(4)) + 1).cast("int").alias("quarter"))


def next_period(year: Column, quarter: Column) -> Column:
    """Struct of the period that follows."""
    return shifted_period(year, quarter, 1)


def previous_period(year: Column, quarter: Column) -> Column:
    """Struct of the period before."""
    return shifted_period(year, quarter, -1)


def is_current_era(year: Column, quarter: Column) -> Column:
    """True after the last quarter published in the legacy layout."""
    y, q = LAST_LEGACY_PERIOD
    return order_key(year, quarter) > y * 10 + q


def current_period(date: Column) -> Column:
    """Struct of the period before the calendar quarter of ``date``.

    In the first calendar quarter this is quarter 0 of the same year.
    """
    return F.struct(F.year(date).alias("year"), (F.quarter(date) - 1).alias("quarter"))


def known_indexes(date: Column) -> Column:
    """Array of all positions from the first quarter to before the current period."""
    now = current_period(date)
    # quarter 0 stands for "no quarter of this year is complete"
    end = now["year"] * 4 + F.greatest(now["quarter"], F.lit(1)) - 2
    return F.sequence(F.lit(quarter_index(*FIRST_PERIOD)), end.cast("int"))


def resolve_period(name: Column) -> Column:
    """Struct of the period in an archive name, null if there is none."""
    year = F.nullif(F.regexp_extract(name, NAME_PATTERN, 1), F.lit(""))
    quarter = F.nullif(F.regexp_extract(name, NAME_PATTERN, 2), F.lit(""))
    found = F.struct(year.cast("int").alias("year"), quarter.cast("int").alias("quarter"))
    return F.when(year.isNotNull(), found)


def archive_url(year: Column, quarter: Column) -> Column:
    """Download address of a quarter's archive; the two eras spell it differently."""
    current = is_current_era(year, quarter)
    return F.format_string(
        ARCHIVE_URL,
        F.when(current, F.lit(CURRENT_PREFIX)).otherwise(F.lit(LEGACY_PREFIX)),
        year.cast("int"),
        F.when(current, F.lit("Q")).otherwise(F.lit("q")),
        quarter.cast("int"),
    )
