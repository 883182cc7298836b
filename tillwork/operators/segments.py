"""Clamped balances in segments of a ledger.

A balance that never falls below zero maps what it opens with to what it closes with: after a run of
flows with sum S whose prefix sums are at least L, an opening b closes at max(b + S, S - L). A pair
(S, S - L) therefore stands for the whole run, and pairs of neighbouring runs combine to one of the
same form. So a ledger is cut into segments, each is summed up by itself, the openings of the
segments follow from the pairs before them, and the rows of a segment need its opening alone.

An entity with very many rows is spread over as many tasks as it has segments; only its pairs, one
for each segment, meet. Further days need the balances that the days before them closed with, and
no row of these.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _prefixes(df: DataFrame, entity: Sequence[str], order: Sequence[str], flow: Column) -> DataFrame:
    """Adds ``_sum``, the flows of the segment up to the row, and ``_low``, the lowest of these."""
    to_here = (
        Window.partitionBy(*entity, "_segment")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = df.withColumn("_sum", F.sum(flow).over(to_here))
    return summed.withColumn("_low", F.min("_sum").over(to_here))


def segment_pairs(df: DataFrame, entity: Sequence[str], flow: Column, order: Sequence[str]) -> DataFrame:
    """One row for each entity and ``_segment``: ``_total``, the sum of its flows, and ``_floor``,
    what it closes with at least."""
    last = _prefixes(df, entity, order, flow).groupBy(*entity, "_segment").agg(
        # The last sum is that of the row with the greatest order.
        F.max(F.struct(*order, F.col("_sum").alias("_sum")))["_sum"].alias("_total"),
        F.min("_low").alias("_low"),
    )
    return last.select(*entity, "_segment", "_total", (F.col("_total") - F.col("_low")).alias("_floor"))


def segment_openings(pairs: DataFrame, entity: Sequence[str], base: str) -> DataFrame:
    """``pairs`` with ``_opening``, the balance that each segment opens with; ``base`` holds that of
    the entity's first one."""
    before = Window.partitionBy(*entity).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy(*entity).orderBy("_segment").rowsBetween(Window.unboundedPreceding, 0)
    through = F.sum("_total").over(to_here)
    marked = pairs.withColumn("_through", through).withColumn("_lift", F.col("_floor") - F.col("_through"))
    reached = F.coalesce(F.sum("_total").over(before), F.lit(0))
    lift = F.greatest(F.col(base), F.max("_lift").over(before))
    return marked.withColumn("_opening", reached + lift).drop("_through", "_lift")


def balance_in_segments(
    df: DataFrame,
    entity: Sequence[str],
    order: str | Sequence[str],
    flow: Column,
    base: Column,
    out: str,
    segment: Column,
) -> DataFrame:
    """``df`` with ``out``, the balance after each row, as ``clamped_balance`` gives it.

    ``segment`` numbers runs of an entity's rows in their order, such as its months; rows of one
    segment have one task. ``base`` is the opening balance, the same in all rows of an entity.
    ``order`` is unique for an entity. A NULL flow moves nothing.
    """
    order = [order] if isinstance(order, str) else list(order)
    flow = F.coalesce(flow, F.lit(0))
    cut = df.withColumns({"_segment": segment, "_base": base})
    bases = cut.groupBy(*entity, "_segment").agg(F.first("_base").alias("_base"))
    pairs = segment_pairs(cut, entity, flow, order)
    joined = pairs.alias("p").join(bases.alias("b"), _same([*entity, "_segment"], "p", "b"))
    opened = segment_openings(joined.select("p.*", "b._base"), entity, "_base")
    openings = opened.select(*entity, "_segment", "_opening")
    rows = _prefixes(cut, entity, order, flow).alias("r").join(
        openings.alias("o"), _same([*entity, "_segment"], "r", "o")
    )
    balance = F.greatest(F.col("_opening") + F.col("_sum"), F.col("_sum") - F.col("_low")).cast("bigint")
    return rows.select(*(F.col(f"r.{c}") for c in df.columns if c != out), balance.alias(out))


def closing_balances(ledger: DataFrame, entity: Sequence[str], order: str, balance: str) -> DataFrame:
    """The state that further days open with: each entity's last balance and its ``order``."""
    return ledger.groupBy(*entity).agg(F.max(F.struct(order, balance)).alias("_last")).select(*entity, "_last.*")


def continued(
    state: DataFrame,
    rows: DataFrame,
    entity: Sequence[str],
    order: str,
    flow: Column,
    base: Column,
    out: str,
    segment: Column,
) -> tuple[DataFrame, DataFrame]:
    """The ledger of further ``rows``, and the state after them.

    ``state`` is that of the days before, as ``closing_balances`` gives it, and all that is read of
    them; entities without one open with ``base``. Rows that are not later than their entity's
    state are left out, so that a day that was taken already is not counted again.
    """
    held = state.select(*entity, F.col(order).alias("_until"), F.col(out).alias("_held"))
    opened = (
        rows.alias("r")
        .join(held.alias("s"), _same(entity, "r", "s"), "left")
        .select("r.*", "s._until", "s._held")
        .where(F.col("_until").isNull() | (F.col(order) > F.col("_until")))
    )
    start = F.coalesce("_held", base)
    ledger = balance_in_segments(opened, entity, order, flow, start, out, segment).drop("_until", "_held")
    both = state.select(*entity, order, out).unionByName(ledger.select(*entity, order, out))
    return ledger, closing_balances(both, entity, order, out)
