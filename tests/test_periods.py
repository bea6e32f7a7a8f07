from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterlode.functions import periods as P
from quarterlode.operators import period_sets as S


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("year,quarter,text", [(2024, 1, "24q1"), (2010, 3, "10q3"), (2004, 4, "04q4"), (2024, 0, "24q0")])
def test_text_and_back(spark, year, quarter, text):
    row = one(spark, P.format_period(F.lit(year), F.lit(quarter)), P.period_year(F.lit(text)), P.period_quarter(F.lit(text)))
    assert tuple(row) == (text, year, quarter)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(2000, 2098), st.integers(1, 4)), min_size=2, max_size=40))
def test_next_and_previous_are_inverse_and_ordered(spark, periods):
    df = spark.createDataFrame(periods, "y int, q int")
    y, q = F.col("y"), F.col("q")
    n, p = P.next_period(y, q), P.previous_period(y, q)
    back = P.previous_period(n["year"], n["quarter"])
    ahead = P.next_period(p["year"], p["quarter"])
    ok = (
        (back["year"] == y) & (back["quarter"] == q) & (ahead["year"] == y) & (ahead["quarter"] == q)
        & (P.order_key(n["year"], n["quarter"]) > P.order_key(y, q))
        & (P.order_key(p["year"], p["quarter"]) < P.order_key(y, q)))
    assert df.where(~ok).count() == 0


def test_year_roll_over(spark):
    row = one(spark, P.next_period(F.lit(2024), F.lit(4)), P.previous_period(F.lit(2024), F.lit(1)))
    assert (tuple(row[0]), tuple(row[1])) == ((2025, 1), (2023, 4))


def test_era_and_address(spark):
    old, new = (F.lit(2012), F.lit(3)), (F.lit(2012), F.lit(4))
    row = one(spark, P.is_current_era(*old), P.is_current_era(*new), P.archive_url(F.lit(2010), F.lit(2)),
              P.archive_url(F.lit(2024), F.lit(2)))
    assert row[0] is False and row[1] is True
    assert row[2].endswith("/aers_ascii_2010q2.zip") and row[3].endswith("/faers_ascii_2024Q2.zip")


@pytest.mark.parametrize("name,want", [
    ("aers_ascii_2010q2.zip", (2010, 2)), ("faers_ascii_2024Q3.zip", (2024, 3)), ("no_period_here.zip", None)])
def test_resolve(spark, name, want):
    found = one(spark, P.resolve_period(F.lit(name)))[0]
    assert (found and tuple(found)) == want


@pytest.mark.parametrize("date,current,last", [
    ((2024, 7, 15), (2024, 2), "24q1"), ((2024, 1, 20), (2024, 0), "23q4"), ((2013, 10, 1), (2013, 3), "13q2"),
    ((2024, 4, 1), (2024, 1), "23q4"), ((2024, 12, 31), (2024, 3), "24q2")])
def test_current_and_last_listed(spark, date, current, last):
    day = dt.date(*date)
    assert tuple(one(spark, P.current_period(F.lit(day)))[0]) == current
    known = [r.period for r in S.all_periods_on(spark, day).collect()]
    assert (known[0], known[-1]) == ("04q1", last)
    assert len(known) == len(set(known))


def test_eras_of_all_periods(spark):
    known = S.all_periods_on(spark, dt.date(2013, 11, 1))
    assert known.where("not current_era").count() == 35
    assert [r.period for r in known.where("current_era").collect()] == ["12q4", "13q1", "13q2"]


def test_missing_periods(spark, rows):
    known = spark.createDataFrame([("12q4",), ("13q1",), ("13q2",), ("13q3",)], "period string")
    present = spark.createDataFrame([("12q4",), ("13q2",), ("13q2",), (None,)], "period string")
    assert rows(S.missing_periods(known, present)) == [("13q1",), ("13q3",)]
    assert rows(S.missing_periods(known, present.limit(0))) == rows(known)


def test_period_text_and_first(spark):
    df = spark.createDataFrame([("24q2",), ("24q1",), ("24q1",), (None,)], "period string")
    assert S.periods_text(df).first()[0] == "24q1,24q2"
    assert S.periods_text(df.limit(0)).first()[0] == ""
    assert one(spark, S.first_periods(F.lit("24q1, 24q2 ,24q3"), 2))[0] == ["24q1", "24q2"]


def test_archive_names(spark, rows):
    names = spark.createDataFrame([("aers_ascii_2010q2.zip",), ("x.zip",)], "name string")
    assert rows(S.periods_of_archives(names)) == [("10q2",)]
