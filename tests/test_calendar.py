import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.functions import retail_calendar as rc
from tillwork.operators import rollups
from tillwork.operators.calendar import calendar_spanning, commerce_calendar

D = dt.date

KNOWN = [
    # date, year, quarter, month, week, week of quarter, sss, mc
    (D(2025, 1, 2), 2025, 1, 1, 1, 1, 20240104, 20240102),
    (D(2025, 6, 15), 2025, 2, 6, 24, 11, 20240616, 20240615),
    (D(2025, 6, 1), 2025, 2, 6, 22, 9, 20240602, 20240601),
    (D(2025, 12, 31), 2026, 1, 1, 1, 1, 20250101, 20241231),
    (D(2023, 12, 31), 2023, 4, 12, 53, 14, 20230101, 20221231),
    (D(2012, 12, 24), 2012, 4, 12, 53, 14, 20111226, 20111224),
    (D(2012, 12, 30), 2012, 4, 12, 53, 14, 20120101, 20111230),
    (D(2024, 2, 29), 2024, 1, 3, 9, 9, 20230302, 20230228),
]


@pytest.mark.parametrize("known", KNOWN, ids=lambda k: str(k[0]))
def test_known_days(spark, known):
    day = known[0]
    got = commerce_calendar(spark, day, day).select(
        "date_value", "commerce_year", "commerce_quarter", "commerce_month", "commerce_week",
        "quarter_week", "date_key_sss", "date_key_mc",
    )
    assert rows(got) == [known]


def test_one_year(spark):
    year = commerce_calendar(spark, D(2025, 1, 1), D(2025, 12, 31))
    got = rows(year, "date_key")
    assert len(got) == len({r[0] for r in got}) == 365
    assert year.columns == list(rc.CALENDAR_COLUMNS)
    first = {r.quarter_week for r in year.where("commerce_quarter = 1").collect()}
    assert first == set(range(1, 14))
    swapped = commerce_calendar(spark, D(2025, 12, 31), D(2025, 1, 1))
    assert rows(swapped, "date_key") == got


def test_every_year_is_cut_4_4_5(spark):
    # 1980..2050 holds all kinds of years, also leap years from a Sunday on.
    days = commerce_calendar(spark, D(1980, 1, 7), D(2050, 12, 25))
    whole = days.where("commerce_year between 1981 and 2049")
    months = whole.groupBy("commerce_year", "commerce_month").agg(
        F.count("*").alias("days"), F.count_distinct("commerce_week").alias("weeks")
    )
    for year, month, n, weeks in rows(months):
        extra = month == 12 and weeks == 6
        assert 1 <= month <= 12
        assert weeks == (5 if month % 3 == 0 else 4) + extra, (year, month)
        assert n == 7 * weeks
    years = whole.groupBy("commerce_year").agg(
        F.min("date_value").alias("first"),
        F.max("date_value").alias("last"),
        F.max("commerce_week").alias("weeks"),
    )
    for year, first, last, weeks in rows(years):
        assert first.weekday() == 0 and first <= D(year, 1, 1) <= first + dt.timedelta(6)
        assert (last - first).days == 7 * weeks - 1
    long = {r[0] for r in rows(years) if r[3] == 53}
    assert long == {1984, 1989, 1995, 2000, 2006, 2012, 2017, 2023, 2028, 2034, 2040, 2045}


def test_python_dates_agree(spark):
    got = commerce_calendar(spark, D(1999, 12, 1), D(2001, 2, 1)).collect()
    for r in got:
        d = r.date_value
        assert r.date_key == d.year * 10000 + d.month * 100 + d.day
        assert (r.iso_year, r.iso_week, r.day_of_week) == tuple(d.isocalendar())
        assert r.day_name == d.strftime("%a") and r.is_weekend == (d.weekday() >= 5)
        before = d - dt.timedelta(364)
        assert r.date_key_sss == int(before.strftime("%Y%m%d"))
        assert before.weekday() == d.weekday()
        assert r.commerce_period == f"{r.commerce_year}-{r.commerce_month:02d}"


def test_keys_to_days(spark):
    keys = [20240229, 20230229, 20231301, 20230431, 19950102, 0, None]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r[0] for r in df.select(rc.day_of_key("k")).collect()]
    assert got == [D(2024, 2, 29), None, None, None, D(1995, 1, 2), None, None]


def test_attach_needs_no_shuffle(spark):
    fact = spark.range(10).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"))
    got = rc.attach_calendar(fact, "d", ("commerce_week", "date_key"))
    assert got.columns == ["d", "commerce_week", "date_key"]
    assert "Exchange" not in plan(got)


def test_period_starts_and_span(spark):
    fact = spark.createDataFrame([(D(2025, 1, 6),), (D(2025, 2, 10),)], "d date")
    span = calendar_spanning(fact, "d")
    assert span.count() == 36
    assert rows(rollups.period_starts(span)) == [
        ("2025-01", D(2025, 1, 6)),
        ("2025-02", D(2025, 1, 27)),
    ]
