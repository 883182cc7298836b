"""Dimension lookups and year-ago comparisons.

No join forces a broadcast: Catalyst and AQE compare measured sizes with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise take a sort-merge join whose
skewed partitions AQE splits. A calendar (one short row per day) is always below
that limit, so its joins are broadcast joins in practice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.retail_calendar import SAME_WEEKDAY_LAG, date_key_mc, date_key_sss

def join_calendar(
    fact: DataFrame,
    calendar: DataFrame,
    columns: Sequence[str],
    key: str = "date_key",
    how: str = "inner",
) -> DataFrame:
    """Calendar attributes by key; days outside the calendar drop out (inner) or
    keep NULLs (left)."""
    return fact.join(calendar.select(key, *[c for c in columns if c != key]), key, how)


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Chosen attributes of a dimension that is unique on ``keys``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(dimension.select(*keys, *columns), keys, how)


def year_ago_by_window(
    df: DataFrame,
    entity: str,
    day: str,
    values: Mapping[str, str],
    lag_days: int = SAME_WEEKDAY_LAG,
) -> DataFrame:
    """Values of the row ``lag_days`` earlier, as a one-day range frame.

    ``values`` maps source columns to output names. ``df`` must hold one row per
    (entity, day), which also bounds a window partition by the number of days. A
    row without a day has no row before it: the frame of a NULL would hold all
    rows without a day.
    """
    then = Window.partitionBy(entity).orderBy(F.unix_date(day)).rangeBetween(-lag_days, -lag_days)
    known = F.col(day).isNotNull()
    return df.withColumns({out: F.when(known, F.max(c).over(then)) for c, out in values.items()})


def month_close_by_window(
    df: DataFrame, entity: str, key: str, values: Mapping[str, str]
) -> DataFrame:
    """Values of the same calendar date one year earlier, by YYYYMMDD key.

    One year is 10,000 on that key; February 29 looks one further, at the 28th.
    """
    by_key = Window.partitionBy(entity).orderBy(key)
    same = by_key.rangeBetween(-10_000, -10_000)
    clamped = by_key.rangeBetween(-10_001, -10_001)
    leap_day = F.col(key) % 10_000 == 229
    return df.withColumns(
        {
            out: F.when(leap_day, F.max(c).over(clamped)).when(
                F.col(key).isNotNull(), F.max(c).over(same)
            )
            for c, out in values.items()
        }
    )


def _lookup(df: DataFrame, entity: str, key: str, target: str, values: Mapping[str, str]):
    before = df.select(
        F.col(entity), F.col(key).alias(target), *[F.col(c).alias(o) for c, o in values.items()]
    )
    return df.join(before, [entity, target], "left").select(*df.columns, *values.values())


def year_ago_by_join(
    df: DataFrame,
    entity: str,
    key: str,
    target: str,
    values: Mapping[str, str],
) -> DataFrame:
    """The same lookup as a left self join of ``target`` (a key column) with ``key``.

    Only the key and value columns travel on the looked-up side.
    """
    return _lookup(df, entity, key, target, values)


def with_comparison_keys(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns({"date_key_sss": date_key_sss(day), "date_key_mc": date_key_mc(day)})
