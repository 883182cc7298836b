"""The 4-4-5 commerce calendar as column expressions.

A commerce year starts on the Monday on or before January 1 and is cut into
four quarters of 13 weeks, each split 4-4-5 into months. Everything is closed
form over one date column, so a fact gets its calendar attributes without a
join and without a Python function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weeks per month inside a quarter, weeks per quarter, days to the
# same weekday one commerce year earlier, and the day labels from Monday on.
MONTH_WEEKS = (4, 4, 5)
QUARTER_WEEKS = 13
SAME_WEEKDAY_LAG = 364
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# The published columns of the calendar.
CALENDAR_COLUMNS = (
    "date_key",
    "date_value",
    "commerce_year",
    "commerce_quarter",
    "commerce_month",
    "commerce_period",
    "commerce_week",
    "quarter_week",
    "iso_year",
    "iso_week",
    "day_of_week",
    "day_name",
    "is_weekend",
    "date_key_sss",
    "date_key_mc",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(day: Column | str) -> Column:
    """YYYYMMDD as a bigint; plain arithmetic, no text formatting."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def day_of_key(key: Column | str) -> Column:
    """The date behind a YYYYMMDD key; NULL when the key is no valid date.

    Arithmetic only: parsing the key as text costs several times as much.
    """
    key = _col(key)
    year, month = (key / 10_000).cast("int"), (key / 100).cast("int") % 100
    real_month = month.between(1, 12) & year.between(1, 9999)
    first = F.when(real_month, F.make_date(year, month, F.lit(1)))
    offset = (key % 100).cast("int") - 1
    in_month = offset.between(0, F.dayofmonth(F.last_day(first)) - 1)
    return F.when(in_month, F.date_add(first, offset))


def monday_of(day: Column | str) -> Column:
    day = _col(day)
    return F.date_sub(day, F.weekday(day))


def shift_years(day: Column | str, years: int) -> Column:
    """Same month and day in another year; February 29 clamps to 28."""
    return F.add_months(_col(day), 12 * years)


def commerce_year(day: Column | str) -> Column:
    """The week holding January 1 belongs to the new year: ask its Sunday."""
    return F.year(F.date_add(monday_of(day), 6))


def commerce_week(day: Column | str) -> Column:
    """1..52, or 53 in the years that have a full extra week."""
    return _week_of(day, commerce_year(day))


def _week_of(day: Column | str, year: Column) -> Column:
    first = monday_of(F.make_date(year, F.lit(1), F.lit(1)))
    return (F.datediff(monday_of(day), first) / 7).cast("int") + 1


def _regular(week: Column) -> Column:
    # Zero-based and held at 51: week 53 stays in the last month and quarter,
    # also in leap years that start on a Sunday.
    return F.least(week, F.lit(4 * QUARTER_WEEKS)) - 1


def quarter_of_week(week: Column) -> Column:
    return (_regular(week) / QUARTER_WEEKS).cast("int") + 1


def month_of_week(week: Column) -> Column:
    slot = _regular(week) % QUARTER_WEEKS
    second, third = MONTH_WEEKS[0], MONTH_WEEKS[0] + MONTH_WEEKS[1]
    in_quarter = F.when(slot < second, 1).when(slot < third, 2).otherwise(3)
    return (quarter_of_week(week) - 1) * 3 + in_quarter


def commerce_period(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def date_key_sss(day: Column | str) -> Column:
    return date_key(F.date_sub(_col(day), SAME_WEEKDAY_LAG))


def date_key_mc(day: Column | str) -> Column:
    return date_key(shift_years(day, -1))


def day_name(day: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.weekday(_col(day)) + 1)


def calendar_expressions(
    day: Column | str, columns: tuple[str, ...] = CALENDAR_COLUMNS
) -> dict[str, Column]:
    """The chosen calendar attributes of ``day``, by column name."""
    day = _col(day)
    year = commerce_year(day)
    week = _week_of(day, year)
    make = {
        "date_key": lambda: date_key(day),
        "date_value": lambda: day,
        "commerce_year": lambda: year,
        "commerce_quarter": lambda: quarter_of_week(week),
        "commerce_month": lambda: month_of_week(week),
        "commerce_period": lambda: commerce_period(year, month_of_week(week)),
        "commerce_week": lambda: week,
        "quarter_week": lambda: week - (quarter_of_week(week) - 1) * QUARTER_WEEKS,
        "iso_year": lambda: F.extract(F.lit("YEAROFWEEK"), day),
        "iso_week": lambda: F.weekofyear(day),
        "day_of_week": lambda: F.weekday(day) + 1,
        "day_name": lambda: day_name(day),
        "is_weekend": lambda: F.weekday(day) >= 5,
        "date_key_sss": lambda: date_key_sss(day),
        "date_key_mc": lambda: date_key_mc(day),
    }
    return {c: make[c]() for c in columns}


def attach_calendar(
    df: DataFrame, day: str, columns: tuple[str, ...] = CALENDAR_COLUMNS
) -> DataFrame:
    """Add calendar attributes to a fact with a date column; no join, no shuffle."""
    return df.withColumns(calendar_expressions(day, tuple(c for c in columns if c != day)))
