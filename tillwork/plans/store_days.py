"""The store-day fact as a stored table: bucketed by store, corrected where a correction reaches.

The table is partitioned by commerce year and period and bucketed by store, so that windows and
year-ago lookups of a store's days read it without an exchange, and a correction rewrites the
periods it reaches and leaves the files of all others as they are.

A changed (day, store) reaches the rest of its commerce year (running totals), the same weekday
a year on and, with month close, the same date a year on. What a store sold on its other days
is in the stored fact itself, so that of the sales only the changed store days are read again.

The list of periods comes to the driver, twelve a year at most. All rows stay in Spark. A
correction that was stopped can be run again: it reads what it needs from sales and from columns
that it does not change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.retail_calendar import SAME_WEEKDAY_LAG, attach_calendar, day_of_key
from ..operators.upsert import STORED
from ..session import fresh_dir, remove, shuffles_dropped
from . import star

STORE, DAY = "store_key", "date_key"
YEAR, PERIOD = "commerce_year", "commerce_period"
BUCKETS = 16
# A date a year earlier may lie two commerce years back: 2024-12-30 is in 2025, 2023-12-30 in 2023.
YEARS_BACK = 2
# A task reads a whole bucket and sorts it for several windows, at about 1.2 KB a store day.
ROWS_PER_BUCKET = 500_000
# The task that writes a dealt fact holds its rows for the windows and sorts them for the files as
# well, at about 1.8 KB a store day.
ROWS_PER_DEALT_BUCKET = 350_000
LEAST_BUCKETS = 4


def buckets_for(sales: DataFrame, dealt: bool = False) -> int:
    """Buckets for the store days of ``sales``, of about ``ROWS_PER_BUCKET`` each, so that a task
    stays as large as it is however many stores there are; ``dealt`` as in ``write_store_days``.

    The store days are estimated within 5 % by one pass over the two key columns, without a
    shuffle. A stored table keeps its buckets; one that has grown many times is written anew.
    """
    store_days = F.approx_count_distinct(F.xxhash64(DAY, STORE)).alias("n")
    rows = sales.agg(store_days).first()["n"]
    return max(LEAST_BUCKETS, -(-rows // (ROWS_PER_DEALT_BUCKET if dealt else ROWS_PER_BUCKET)))


def write_store_days(df: DataFrame, table: str, buckets: int = BUCKETS, dealt: bool = False) -> str:
    """The table becomes the rows of a store-day fact or of its base, bucketed by store.

    A store has one row a day, so that no bucket is hot; rows are dealt as the buckets are, which
    gives each period one file a bucket. ``buckets`` should follow the number of store days, see
    ``buckets_for``. ``dealt`` says that the frame was built with as many ``buckets`` (see
    ``star.fact_store_day``), and saves moving its finished rows, which are the widest.
    """
    rows = df if dealt else _dealt(df, buckets)
    writer = rows.write.format("parquet").options(**STORED).mode("overwrite")
    # Kept with the table, so that later writes replace single partitions in any session.
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(YEAR, PERIOD)
    with shuffles_dropped(df.sparkSession):
        writer.bucketBy(buckets, STORE).sortBy(STORE, DAY).saveAsTable(table)
    return table


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(buckets, STORE)


def buckets_of(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} is not bucketed")
    return int(described["data_type"])


def fact_of_stored(base: DataFrame, month_close: bool = False) -> DataFrame:
    """The store-day fact from stored store days, with or without their derived columns."""
    return star.with_store_day_measures(base.select(*star.STORE_DAY_BASE), month_close=month_close)


def correct_store_days(
    spark: SparkSession,
    table: str,
    changed: DataFrame,
    sales: DataFrame,
    stores: DataFrame,
    kpi: DataFrame,
    as_of: str | None = None,
) -> list[str]:
    """Bring ``table`` up to ``sales`` and ``kpi`` after changes on the (day, store) keys of
    ``changed``; returns the periods that were rewritten.

    The table then equals a full rebuild, if ``stores`` is as it was and the table was built with
    days computed from their keys. Keys may repeat; those that are no day are ignored. A store day
    whose sales are gone leaves the table.
    """
    held = spark.table(table)
    month_close = set(star.MONTH_CLOSE) <= set(held.columns)
    keys_at, staged = fresh_dir(spark, "changed"), fresh_dir(spark, "corrected")
    changed.select(DAY, STORE).distinct().write.parquet(keys_at)
    keys = spark.read.schema(changed.select(DAY, STORE).schema).parquet(keys_at)
    dated = attach_calendar(
        keys.withColumn("date_value", day_of_key(DAY)).where(F.col("date_value").isNotNull()),
        "date_value",
        (YEAR, PERIOD),
    )
    reached, years = _reached(dated, month_close)
    if not years:
        remove(spark, keys_at)
        return []
    low, high = dated.agg(F.min(DAY), F.max(DAY)).first()
    in_days = F.col(DAY).between(low, high)
    own = keys.select(STORE).distinct()

    again = star.store_day_base(
        sales.where(in_days).join(keys, [DAY, STORE], "left_semi"), stores, kpi.where(in_days), as_of=as_of
    )
    history = held.where(F.col(YEAR).isin(_with_earlier(years))).select(*star.STORE_DAY_BASE)
    other_days = history.join(own, STORE, "left_semi").join(keys, [DAY, STORE], "left_anti")
    corrected = fact_of_stored(other_days.unionByName(again), month_close).where(reached)
    other_stores = held.where(reached).join(own, STORE, "left_anti")
    before = _places(held.where(reached))
    state = other_stores.unionByName(corrected).select(*held.columns)
    with shuffles_dropped(spark):
        state.write.options(**STORED).parquet(staged)

    state = spark.read.schema(held.schema).parquet(staged)
    after = _places(state)
    with shuffles_dropped(spark):
        _dealt(state, buckets_of(spark, table)).write.mode("overwrite").insertInto(table)
    _drop_places(spark, table, before - after)
    spark.catalog.refreshTable(table)
    remove(spark, staged)
    remove(spark, keys_at)
    return sorted(period for _, period in before | after)


def _reached(dated: DataFrame, month_close: bool) -> tuple[Column, list[int]]:
    """A condition on the partitions that the changed days reach, and their years."""
    day = F.col("date_value")
    later = [F.date_add(day, SAME_WEEKDAY_LAG)]
    if month_close:
        year_on = F.add_months(day, 12)
        # The 29th of February looks at the 28th a year before it.
        later += [year_on, F.date_add(year_on, 1)]
    echoes = dated.select(F.explode(F.array(*later)).alias("date_value"))
    places = _places(attach_calendar(echoes, "date_value", (YEAR, PERIOD)))
    firsts = [tuple(r) for r in dated.groupBy(YEAR).agg(F.min(PERIOD)).collect()]
    conditions = [(F.col(YEAR) == y) & (F.col(PERIOD) >= first) for y, first in firsts]
    conditions += [(F.col(YEAR) == y) & (F.col(PERIOD) == p) for y, p in sorted(places)]
    years = sorted({y for y, _ in firsts} | {y for y, _ in places})
    return reduce(lambda a, b: a | b, conditions, F.lit(False)), years


def _with_earlier(years: list[int]) -> list[int]:
    return sorted({y - k for y in years for k in range(YEARS_BACK + 1)})


def _places(df: DataFrame) -> set[tuple[int, str]]:
    return {tuple(r) for r in df.select(YEAR, PERIOD).distinct().collect()}


def _drop_places(spark: SparkSession, table: str, places: set[tuple[int, str]]) -> None:
    if places:
        named = ", ".join(f"PARTITION ({YEAR} = {y}, {PERIOD} = '{p}')" for y, p in sorted(places))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")
