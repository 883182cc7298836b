"""Clustering on several columns at once.

A lexicographic order serves filters on its first column only. Here each column's values become
ranks among their quantiles, and the bits of the ranks are interleaved to one key: rows that are
near in all columns get near keys, so that a file covers a short range of every column, and Parquet
statistics skip files and row groups for a filter on any of them.

Ranks come from quantiles, not from values, so skewed columns and very different domains cut the
rows equally often. The cuts of all columns are one aggregate of the table, and a few hundred
numbers on the driver; everything else is an expression of the row and one range sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir, remove
from .upsert import new_version, overwrite_partitions, partition_columns, point_to

BITS = 8
KEY_BITS = 62
ACCURACY = 10_000
TEXT_BYTES = 7


def ordinal(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values; texts are ordered by their first bytes."""
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.substring(F.hex(F.encode(value, "UTF-8")), 1, 2 * TEXT_BYTES)
        return F.conv(F.rpad(head, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int) -> list[list[float]]:
    """For each column the values that cut its rows into 2**bits equal parts."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(
        *(F.percentile_approx(ordinal(df, c), shares, ACCURACY).alias(f"_{k}") for k, c in enumerate(columns))
    ).first()
    return [list(cuts) if cuts else [] for cuts in found]


def rank_among(value: Column, cuts: Sequence[float], bits: int) -> Column:
    """How many cuts are not above the value, by bisection; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    held = F.array(*(F.lit(float(c)) for c in cuts))
    steps = F.array(*(F.lit(2**k) for k in reversed(range(bits))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(held, at + step - 1) <= value, at + step).otherwise(at),
    )


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number with the highest bits of all ranks first."""
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(1).cast("long"))
    return key


def zordered(df: DataFrame, columns: Sequence[str], files: int | None = None, within: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt and sorted by the interleaved ranks of ``columns``; ``within`` sorts first."""
    if not columns:
        raise ValueError("no column to cluster on")
    bits = max(1, min(BITS, KEY_BITS // len(columns)))
    cuts = quantile_cuts(df, columns, bits)
    ranks = [rank_among(ordinal(df, c), found, bits) for c, found in zip(columns, cuts, strict=True)]
    names = [f"_rank_{k}" for k in range(len(ranks))]
    ranked = df.withColumns(dict(zip(names, ranks, strict=True)))
    keyed = ranked.withColumn("_place", interleaved([F.col(n) for n in names], bits)).drop(*names)
    # Equal places are in the order of the columns, so that runs of equal values stay together.
    order = [*within, "_place", *(c for c in columns if c not in within)]
    ranged = keyed.repartitionByRange(*([files] if files else []), *order)
    return ranged.sortWithinPartitions(*order).drop("_place")


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> str:
    zordered(df, columns, files).write.mode("errorifexists").parquet(path)
    return path


def zorder_table(spark: SparkSession, table: str, columns: Sequence[str], files: int | None = None) -> None:
    """Rewrite a table in the interleaved order.

    A table without partitions is written beside its old files and then switched to them; of a
    partitioned one each partition is replaced from a staged copy, so that the last step can be
    repeated.
    """
    parts = partition_columns(spark, table)
    chosen = [c for c in columns if c not in parts]
    if not parts:
        point_to(spark, table, write_zordered(spark.table(table), new_version(spark, table), chosen, files))
        return
    staged = fresh_dir(spark, "zorder")
    whole = spark.table(table)
    whole.write.parquet(staged)
    copy = spark.read.schema(whole.schema).parquet(staged)
    overwrite_partitions(spark, zordered(copy, chosen, files, within=parts), table, parts)
    remove(spark, staged)
