"""Running totals and clamped balances over days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(value: str, by: Sequence[str], order: Sequence[str]) -> Column:
    """Sum from the start of the group to the current row.

    Meant for rolled-up facts with one row per (entity, day): a group then has at
    most as many rows as its period has days, whatever the sales behind it.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def with_running_totals(
    df: DataFrame, value: str, entity: str, year: str, month: str, order: str
) -> DataFrame:
    """Month-to-date and year-to-date of ``value`` per entity.

    Months follow each other within a year, so ordering the year by (month, day)
    is ordering it by day; spelled that way both totals share one sort.
    """
    return df.withColumns(
        {
            "mtd_sales": running_total(value, [entity, year, month], [order]),
            "ytd_sales": running_total(value, [entity, year], [month, order]),
        }
    )


def clamped_balance(
    df: DataFrame, entity: Sequence[str], order: str, flow: Column, base: Column, out: str
) -> DataFrame:
    """A running balance that never falls below zero.

    With S the unclamped running sum from ``base``, the balance that restarts at
    zero whenever it would turn negative equals S minus the lowest S below zero
    seen so far. Both windows share one exchange and one sort.
    """
    to_here = (
        Window.partitionBy(*entity)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    opened = df.withColumn("_free", base + F.sum(flow).over(to_here))
    lowest = F.least(F.lit(0), F.min("_free").over(to_here))
    return opened.withColumn(out, (F.col("_free") - lowest).cast("bigint")).drop("_free")
