"""Keyed upserts on plain Parquet tables.

Parquet tables have no MERGE. The merged state is ``target ANTI batch`` plus the
batch: with a small batch AQE broadcasts its keys and the target streams through
without a shuffle. Keys match null-safe. All matched rows are replaced, new ones
added, none deleted.

What a batch does not say stays: columns it lacks keep their stored values. Its
values are cast to the stored types, and a value that does not fit raises. Of
several rows for a key the last one in ``order`` counts. With ``versions``, columns that are stored
with the rows, a row that is older than the stored one for its key is left out, so that a late
delivery of old values loses in whatever batch it comes.

A partitioned target is rewritten where the batch touches it and nowhere else.
Another target becomes a new version beside the old one, beneath its schema's
folder; ``OLD_VERSIONS`` of the replaced ones stay. The shared scratch folder
holds staged data alone, which goes when the upsert has ended.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir, remove, subfolders
from .columns import keys_first
from .dedupe import keep_first, keep_last

OLD_VERSIONS = 1

# Stored tables are written once and read by later steps: zstd moves about a third less than snappy.
STORED = {"compression": "zstd"}


def null_safe_match(left: str, right: str, keys: Sequence[str]):
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def completed(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch with the target's types, and stored values in the columns it lacks."""
    kinds = {f.name: f.dataType for f in target.schema}
    typed = batch.select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in batch.columns]
    )
    absent = [c for c in target.columns if c not in batch.columns]
    if not absent:
        return typed
    stored = target.select(*keys, *absent).alias("t")
    joined = typed.alias("b").join(stored, null_safe_match("b", "t", keys), "left")
    return joined.select("b.*", *[F.col(f"t.{c}") for c in absent])


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the upsert. ``batch`` must be unique on ``keys``.

    Columns that only the batch has are NULL in the rows it leaves alone.
    """
    untouched = target.alias("t").join(
        batch.select(*keys).alias("b"), null_safe_match("t", "b", keys), "left_anti"
    )
    return untouched.unionByName(completed(target, batch, keys), allowMissingColumns=True)


def not_older(target: DataFrame, batch: DataFrame, keys: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """The batch without rows that are older than the target's row for their key.

    Versions are compared column by column; NULL is older than any value. Of equal versions the
    batch's row stays.
    """

    def version(side: str):
        return F.struct(*(F.col(f"{side}.{v}") for v in versions))

    stored = target.select(*keys, *(v for v in versions if v not in keys)).alias("t")
    later = null_safe_match("b", "t", keys) & (version("t") > version("b"))
    return batch.alias("b").join(stored, later, "left_anti")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def versions_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table lie: beneath its schema's folder."""
    schema, _, name = table.rpartition(".")
    root = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{name}_versions"


def new_version(spark: SparkSession, table: str) -> str:
    return f"{versions_folder(spark, table)}/{uuid.uuid4().hex}"


def point_to(spark: SparkSession, table: str, path: str) -> None:
    """Make ``table`` show the files at ``path``: one catalog change, no copy. Versions older
    than the last ``OLD_VERSIONS`` are removed."""
    if not table_exists(spark, table):
        spark.catalog.createTable(table, path=path, source="parquet")
        return
    before = table_location(spark, table)
    add_columns(spark, table, spark.read.parquet(path))
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    old = [v for v in subfolders(spark, versions_folder(spark, table)) if not v.endswith(path[-32:])]
    # Sorted from the newest on; the one just replaced is the newest of the old.
    kept = 0
    for version in old:
        kept += 1
        if kept > OLD_VERSIONS and version.rpartition("/")[2] != before.rpartition("/")[2]:
            remove(spark, version)


def add_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Declare the columns of ``df`` that ``table`` lacks."""
    known = set(spark.table(table).columns)
    for f in df.schema:
        if f.name not in known:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")


def stage_batch(
    spark: SparkSession,
    batch: DataFrame,
    keys: Sequence[str],
    path: str,
    unique: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """The batch written once: one row per key, keys first, stamped.

    Everything after it (the anti join, the union, the checks) reads the copy, so
    the cleaning and its shuffle run once. ``unique`` says the batch is already
    one row per key and saves the dedupe. With ``order`` the last row of a key
    stays.
    """
    if not unique:
        batch = keep_last(batch, keys, order) if order else keep_first(batch, keys)
    keys_first(batch, keys).write.options(**STORED).parquet(path)
    return spark.read.parquet(path)


def upsert_table(
    spark: SparkSession,
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    unique: bool = False,
    order: Sequence[str] = (),
    done: Callable[[DataFrame], None] | None = None,
    versions: Sequence[str] = (),
) -> None:
    """Upsert ``batch`` into ``table``, creating it on first use.

    A failed job leaves the old state in place, and a repeat of the same batch gives the same
    table. ``done`` is called with the batch as it was staged, which lasts until it returns; rows
    that lose against newer stored ones are in it. ``versions`` also orders the batch's rows.
    """
    order = order or versions
    if not table_exists(spark, table):
        path = new_version(spark, table)
        fresh = stage_batch(spark, batch, keys, path, unique, order)
        point_to(spark, table, path)
        if done is not None:
            done(fresh)
        return
    staged = fresh_dir(spark, "batch")
    fresh = stage_batch(spark, batch, keys, staged, unique, order)
    winning, won = fresh, fresh_dir(spark, "winning")
    if versions:
        # Written, so that the stored versions are read once and before the table changes.
        not_older(spark.table(table), fresh, keys, versions).write.parquet(won)
        winning = spark.read.schema(fresh.schema).parquet(won)
    columns = partition_columns(spark, table)
    if columns:
        _rewrite_touched(spark, winning, table, keys, columns)
    else:
        path = new_version(spark, table)
        merged(spark.table(table), winning, keys).write.options(**STORED).parquet(path)
        point_to(spark, table, path)
    if done is not None:
        done(fresh)
    remove(spark, staged)
    remove(spark, won)


def _places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def _inside(target: DataFrame, places: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the target in the given partitions.

    Equality lets Spark prune the scan by the partitions that occur; the NULL partition, which
    equality cannot find, is read where it occurs.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    rows = target.join(places.where(known), list(columns), "left_semi").select(*target.columns)
    if places.where(~known).isEmpty():
        return rows
    odd = target.where(~known).alias("t").join(
        places.where(~known).alias("b"), null_safe_match("t", "b", columns), "left_semi"
    )
    return rows.unionByName(odd)


def overwrite_partitions(
    spark: SparkSession, df: DataFrame, table: str, columns: Sequence[str]
) -> None:
    """Replace the partitions that occur in ``df`` and tell the catalog of new ones.

    The write goes to the table's folder: options that a table was created with would otherwise
    decide whether its other partitions stay.
    """
    (
        df.write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*columns)
        .parquet(table_location(spark, table))
    )
    spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
    spark.catalog.refreshTable(table)


def _rewrite_touched(
    spark: SparkSession, fresh: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str]
) -> None:
    target = spark.table(table)
    places = fresh
    if not set(columns) <= set(fresh.columns):
        places = completed(target, fresh, keys)
    touched = _places(places, columns)
    if not set(columns) <= set(keys):
        # A key may sit in another partition than the one its new row belongs to.
        matched = target.alias("t").join(
            fresh.select(*keys).alias("b"), null_safe_match("t", "b", keys), "left_semi"
        )
        touched = touched.unionByName(_places(matched, columns)).distinct()
    touched_at, staged = fresh_dir(spark, "touched"), fresh_dir(spark, "staged")
    touched.write.parquet(touched_at)
    touched = spark.read.schema(touched.schema).parquet(touched_at)
    merged(_inside(target, touched, columns), fresh, keys).write.parquet(staged)
    state = spark.read.parquet(staged)
    add_columns(spark, table, state)
    # Rebalancing gathers a partition into few files and splits a hot one.
    overwrite_partitions(spark, state.hint("rebalance", *columns), table, columns)
    emptied = touched.alias("t").join(
        _places(state, columns).alias("b"), null_safe_match("t", "b", columns), "left_anti"
    )
    for row in emptied.toLocalIterator():
        values = ", ".join(
            f"`{c}` = " + ("null" if row[c] is None else f"'{row[c]}'") for c in columns
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
    spark.catalog.refreshTable(table)
    remove(spark, touched_at)
    remove(spark, staged)


def upsert_partitions(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    keys: Sequence[str],
    partition: str,
    unique: bool = False,
    order: Sequence[str] = (),
) -> None:
    """Upsert into a Parquet folder partitioned by a key column.

    Only the partitions that occur in the batch are read and rewritten, so the
    cost follows the batch and not the table. The new partitions are staged in
    the shared folder, then replace the old ones by dynamic overwrite; the staged
    copy makes the last step repeatable.
    """
    if partition not in keys:
        raise ValueError("the partition column must be one of the keys")
    batch_at, staged = fresh_dir(spark, "batch"), fresh_dir(spark, "staged")
    fresh = stage_batch(spark, batch, keys, batch_at, unique, order)
    target = _inside(spark.read.parquet(root), _places(fresh, [partition]), [partition])
    merged(target, fresh, keys).write.parquet(staged)
    (
        spark.read.parquet(staged)
        .hint("rebalance", partition)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(partition)
        .parquet(root)
    )
    remove(spark, batch_at)
    remove(spark, staged)
