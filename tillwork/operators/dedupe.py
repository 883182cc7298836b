"""One row per business key, with a survivor that does not depend on the run.

Rows of a key stand in a total order: the given order columns first, all other
columns as tie-break. ``row_number() = 1`` over that order keeps one. Spark
applies the limit of one row per key in every task before the shuffle as well,
so a key that owns a third of the table sends one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], direction: Callable[[str], Column]
) -> DataFrame:
    lead = [c for c in order if c not in keys]
    ranked = lead + [c for c in df.columns if c not in {*keys, *lead}]
    if not ranked:
        return df.select(*keys).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*map(direction, ranked)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key in ascending order, NULLs first."""
    return _keep_one(df, keys, order, F.asc_nulls_first)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key in ascending order."""
    return _keep_one(df, keys, order, F.desc_nulls_last)
