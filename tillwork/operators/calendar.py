"""The commerce calendar as a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.retail_calendar import calendar_expressions


def _days(bounds: DataFrame, first: str, last: str) -> DataFrame:
    low, high = F.least(first, last), F.greatest(first, last)
    return bounds.select(F.explode(F.sequence(low, high)).alias("date_value"))


def _described(days: DataFrame) -> DataFrame:
    return days.select(*[e.alias(c) for c, e in calendar_expressions("date_value").items()])


def commerce_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from start to end inclusive; swapped bounds are allowed."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last")
    )
    return _described(_days(bounds, "first", "last"))


def calendar_spanning(fact: DataFrame, day: str, days_after: int = 0) -> DataFrame:
    """The calendar from the first to the last day of a fact, and some days after."""
    last = F.date_add(F.max(day), days_after)
    return _described(_days(fact.agg(F.min(day).alias("first"), last.alias("last")), "first", "last"))
