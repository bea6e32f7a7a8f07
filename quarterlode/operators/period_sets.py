"""Sets of reporting periods: all known ones, the missing ones, lists as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.functions.periods import (
    archive_url,
    format_index,
    format_period,
    is_current_era,
    known_indexes,
    period_quarter,
    period_year,
    resolve_period,
)
from quarterlode.functions.text import split_list
from quarterlode.sources.tables import distinct_periods


def all_periods(as_of: DataFrame, date: str = "date") -> DataFrame:
    """Every published period as of the date of each row: ``period, year, quarter, current_era``."""
    index = F.col("i")
    year, quarter = F.floor(index / 4).cast("int"), (index % 4 + 1).cast("int")
    return as_of.select(F.explode(known_indexes(F.col(date))).alias("i")).select(
        format_index(index).alias("period"),
        year.alias("year"),
        quarter.alias("quarter"),
        is_current_era(year, quarter).alias("current_era"),
    )


def all_periods_on(spark: SparkSession, date: dt.date) -> DataFrame:
    """Every published period as of one given date."""
    return all_periods(spark.range(1).select(F.lit(date).alias("date")))


def missing_periods(known: DataFrame, present: DataFrame) -> DataFrame:
    """Known periods that a table does not hold yet.

    The distinct periods of a table are at most the quarters since the first
    one, folded before the join.
    """
    return known.select("period").join(distinct_periods(present), "period", "left_anti")


def periods_of_archives(names: DataFrame, name: str = "name") -> DataFrame:
    """Periods that archive names stand for; names without one are left out."""
    found = resolve_period(F.col(name))
    return names.select(found.alias("p")).where("p is not null").select(
        format_period(F.col("p.year"), F.col("p.quarter")).alias("period"))


def periods_text(df: DataFrame, name: str = "periods") -> DataFrame:
    """Sorted, comma-joined distinct periods as one row; empty text if there is none.

    The set is bounded by the calendar: four entries a year.
    """
    return distinct_periods(df).agg(
        F.array_join(F.sort_array(F.collect_set("period")), ",").alias(name))


def first_periods(text: Column, k: int) -> Column:
    """First ``k`` items of a comma list, in the order given, as an array."""
    return F.slice(split_list(text), 1, k)


def periods_to_fetch(known: DataFrame, present: DataFrame, k: int) -> DataFrame:
    """From missing periods to what is fetched next, as one plan: ``place, period, url`` of the first ``k``.

    The missing periods are handed on as sorted text, as between two jobs, and taken from it in order.
    """
    listed = periods_text(missing_periods(known, present))
    chosen = listed.select(F.posexplode(first_periods(F.col("periods"), k)).alias("place", "period"))
    year, quarter = period_year(F.col("period")), period_quarter(F.col("period"))
    return chosen.where("period <> ''").select((F.col("place") + 1).alias("place"), "period", archive_url(year, quarter).alias("url"))
