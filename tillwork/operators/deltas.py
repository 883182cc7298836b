"""Keyed tables that are merged when they are read.

A table is a view over two stored tables: a base, bucketed and sorted by key, and deltas, one
appended batch after the other. An upsert writes its batch and nothing else, so that its cost
follows the batch and not the table. Reading takes, for each key, the newest of the base's row and
the deltas' rows: only the deltas are shuffled, to the base's buckets. Compaction writes the merged
rows as a new base with empty deltas and switches the view, one catalog change, so that readers see
the state before or after it, which hold the same rows.

A row's version decides, not the time it was taken: of two rows for a key the one with the larger
``version`` columns counts, so that an older delivery that is taken later loses; of equal versions
the batch taken last wins. A NULL version is older than any other. Without version columns the
batches' order decides.

Keys are compared null-safe, by one stored text of all key columns. Taking a batch again changes
nothing. What a batch lacks keeps its stored values, and a column it brings is NULL in older rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .upsert import add_columns, completed

KEY, TAKEN = "_key", "_taken"
BUCKETS = 64


def key_text(keys: Sequence[str]) -> Column:
    """One text for the values of all key columns; equal texts mean equal keys, NULLs included."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


class DeltaTable:
    """A keyed table of that kind; its settings are properties of its view.

    ``versions`` names columns of the rows that order deliveries. ``buckets`` is fixed when the
    table is made: as many as its base has gigabytes, or more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        held = {r["key"]: r["value"] for r in rows}
        if "deltas.base" not in held:
            raise ValueError(f"{name} is not a table of this kind")
        self.base, self.deltas = held["deltas.base"], held["deltas.batches"]
        self.keys = held["deltas.keys"].split(",")
        self.versions = [v for v in held["deltas.versions"].split(",") if v]
        self.buckets = int(held["deltas.buckets"])

    @classmethod
    def create(
        cls,
        df: DataFrame,
        name: str,
        keys: Sequence[str],
        versions: Sequence[str] = (),
        buckets: int = BUCKETS,
        unique: bool = False,
    ) -> DeltaTable:
        """A new table with the rows of ``df``, the newest for each key. ``unique`` says that there
        is one row per key."""
        rows = df.withColumn(TAKEN, F.lit(0).cast("long")).withColumn(KEY, key_text(keys))
        _put(df.sparkSession, rows, name, keys, versions, buckets, unique)
        return cls(df.sparkSession, name)

    def take(self, batch: DataFrame, unique: bool = False) -> None:
        """Append a batch. Nothing but the batch is written; a batch with all columns reads
        nothing but the number of the last one. One that is ``unique``, one row per key, is written
        as it lies, without a shuffle."""
        known = self.spark.table(self.name)
        if set(known.columns) - set(batch.columns) or dict(batch.dtypes) != dict(known.dtypes):
            batch = completed(known, batch, self.keys)
        last = self.spark.table(self.deltas).agg(F.max(TAKEN)).first()[0] or 0
        rows = batch.withColumn(TAKEN, F.lit(last + 1).cast("long")).withColumn(KEY, key_text(self.keys))
        add_columns(self.spark, self.deltas, rows)
        columns = self.spark.table(self.deltas).columns
        newest = rows if unique else _newest(rows, self.versions).sortWithinPartitions(KEY)
        newest.select(*columns).write.mode("append").insertInto(self.deltas)
        self.spark.catalog.refreshTable(self.deltas)
        if set(batch.columns) - set(known.columns):
            _point(self.spark, self.name, self.base, self.deltas, self.keys, self.versions, self.buckets)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def refresh(self) -> None:
        """Forget the files known so far; needed where another session, such as that of a stream's
        micro-batches, has written."""
        for part in (self.base, self.deltas):
            self.spark.catalog.refreshTable(part)

    def compact(self) -> None:
        """Make the merged rows the base; the last base and its deltas are dropped once the view
        shows the new ones."""
        base, deltas = self.base, self.deltas
        rows = _merged(self.spark.table(base), self.spark.table(deltas), self.versions, self.buckets)
        _put(self.spark, rows, self.name, self.keys, self.versions, self.buckets, unique=True)
        for old in (base, deltas):
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        self.__init__(self.spark, self.name)


def _newest(rows: DataFrame, versions: Sequence[str]) -> DataFrame:
    """One row per key. Rows beyond the newest go before the shuffle; equal ones are ordered by
    their values, so that the choice does not depend on the partitioning."""
    values = F.xxhash64(*(c for c in rows.columns if c not in (KEY, TAKEN)))
    order = [*(F.col(c).desc_nulls_last() for c in versions), F.desc(TAKEN), F.desc("_mark")]
    first = Window.partitionBy(KEY).orderBy(*order)
    return (
        rows.withColumn("_mark", values)
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") == 1)
        .drop("_place", "_mark")
    )


def _merged(base: DataFrame, deltas: DataFrame, versions: Sequence[str], buckets: int) -> DataFrame:
    """The newest row of base and deltas for each key, with the inner columns. Deltas are dealt to
    as many buckets as the base has, whatever width shuffles have else."""
    fresh = _newest(deltas.repartition(buckets, KEY), versions)
    columns = [*base.columns, *(c for c in fresh.columns if c not in base.columns)]
    old = base.withColumns({c: F.lit(None).cast(fresh.schema[c].dataType) for c in columns if c not in base.columns})
    joined = old.alias("o").join(fresh.alias("n"), F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full")

    def ordered(side: str) -> Column:
        return F.struct(*(F.col(f"{side}.{c}") for c in (*versions, TAKEN)))

    newer = F.col(f"o.{KEY}").isNull() | (F.col(f"n.{KEY}").isNotNull() & (ordered("n") >= ordered("o")))
    return joined.select(*(F.when(newer, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in columns))


def _merged_sql(spark: SparkSession, base: str, deltas: str, versions: Sequence[str], buckets: int) -> str:
    """The statement of the view: the same rows as ``_merged``, without the inner columns."""
    held, fresh = spark.table(base).columns, spark.table(deltas).columns
    order = ", ".join([*(f"`{v}` DESC NULLS LAST" for v in versions), f"{TAKEN} DESC"])
    compared = [*versions, TAKEN]
    newer = (
        f"o.{KEY} IS NULL OR (n.{KEY} IS NOT NULL AND "
        f"struct({', '.join(f'n.`{c}`' for c in compared)}) >= struct({', '.join(f'o.`{c}`' for c in compared)}))"
    )
    shown = [c for c in [*held, *(c for c in fresh if c not in held)] if c not in (KEY, TAKEN)]
    picks = ", ".join(
        f"CASE WHEN {newer} THEN n.`{c}` ELSE {f'o.`{c}`' if c in held else 'NULL'} END AS `{c}`" for c in shown
    )
    return f"""SELECT {picks} FROM {base} o FULL JOIN (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {order}) AS _place
            FROM (SELECT /*+ REPARTITION({buckets}, {KEY}) */ * FROM {deltas}))
        WHERE _place = 1) n ON o.{KEY} = n.{KEY}"""


def _put(
    spark: SparkSession,
    rows: DataFrame,
    name: str,
    keys: Sequence[str],
    versions: Sequence[str],
    buckets: int,
    unique: bool = False,
) -> None:
    """Write ``rows`` as a new base with empty deltas and let the view show them. The new tables
    have names of their own, so that the rows may come from the ones that they replace."""
    mark = uuid.uuid4().hex[:12]
    base, deltas = f"{name}_base_{mark}", f"{name}_deltas_{mark}"
    kept = rows if unique else _newest(rows, versions)
    kept.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).format("parquet").saveAsTable(base)
    spark.createDataFrame([], kept.schema).write.format("parquet").saveAsTable(deltas)
    _point(spark, name, base, deltas, keys, versions, buckets)


def _point(spark, name: str, base: str, deltas: str, keys, versions, buckets: int) -> None:
    held = {
        "deltas.base": base,
        "deltas.batches": deltas,
        "deltas.keys": ",".join(keys),
        "deltas.versions": ",".join(versions),
        "deltas.buckets": str(buckets),
    }
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in held.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS {_merged_sql(spark, base, deltas, versions, buckets)}"
    )
