"""Incremental file intake with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.deltas import DeltaTable
from ..operators.upsert import table_exists, upsert_table
from ..sources.feeds import Feed
from ..sources.raw import READER_OPTIONS, source_path, with_lineage
from ..sources.sinks import STORED


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    table: str,
    fmt: str = "csv",
    max_files: int | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream with lineage columns.

    Wider files need a wider ``schema`` at the next start; Spark reads the columns
    it knows. ``max_files`` bounds a micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**READER_OPTIONS.get(fmt, {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    loaded = reader.load(path).withColumn("_arrived", F.col("_metadata.file_modification_time"))
    return with_lineage(loaded, f"stream:{table}", F.col("_metadata.file_path"))


def feed_stream(spark: SparkSession, root: str, feed: Feed, max_files: int | None = None) -> DataFrame:
    """New files of a feed with the schema and reader options that a batch load of it has."""
    options = {**READER_OPTIONS.get(feed.fmt, {}), **feed.options}
    reader = spark.readStream.format(feed.fmt).schema(feed.schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    loaded = reader.load(source_path(root, feed.path, feed.directory))
    return with_lineage(loaded, f"stream:{feed.table}", F.col("_metadata.file_path"))


def drain_to_table(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Take everything that has arrived, once, and stop.

    The checkpoint makes each file count exactly once over restarts.
    """
    query = (
        stream.drop("_arrived")
        .writeStream.outputMode("append")
        .format("parquet")
        .options(**STORED)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()
    return query


def drain_to_upsert(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    clean=None,
    order: Sequence[str] = ("_arrived",),
    versions: Sequence[str] = (),
) -> StreamingQuery:
    """Drain into a keyed table; a replayed micro-batch leaves it unchanged.

    Of several versions of a key in one micro-batch the last one in ``order`` counts; by default
    that is the one from the file that was written last. ``clean`` may drop rows and keeps the
    order columns; what it returns need not be unique. ``versions`` are stored columns that order
    deliveries over all micro-batches and drains: a row older than the stored one loses.
    """

    def take(batch: DataFrame, _: int) -> None:
        cleaned = clean(batch) if clean else batch
        present = [c for c in order if c in cleaned.columns]
        upsert_table(batch.sparkSession, cleaned, table, keys, order=versions or present, versions=versions)

    return _drained(stream, take, checkpoint, table)


def _drained(
    stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, table: str, mode: str = "append"
) -> StreamingQuery:
    """Run ``take`` for everything that has arrived. Micro-batches write in a session of their own;
    the caller's one is told to look at ``table`` anew."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    if table_exists(spark, table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            DeltaTable(spark, table).refresh()
        else:
            spark.catalog.refreshTable(table)
    return query


def drain_to_deltas(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    versions: Sequence[str] = (),
    clean=None,
    compact_after: int | None = None,
) -> StreamingQuery:
    """Drain into a table that is merged when it is read: each micro-batch writes its own rows.

    The first micro-batch makes the table. With ``compact_after``, a number of micro-batches, the
    table is compacted from time to time.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        cleaned = (clean(batch) if clean else batch).drop("_arrived")
        if not table_exists(spark, table):
            DeltaTable.create(cleaned, table, keys, versions)
            return
        held = DeltaTable(spark, table)
        held.take(cleaned)
        if compact_after and number % compact_after == compact_after - 1:
            held.compact()

    return _drained(stream, take, checkpoint, table)


def drain_rollup(
    stream: DataFrame,
    by: Sequence[str],
    sums: Sequence[str],
    table: str,
    checkpoint: str,
) -> StreamingQuery:
    """Keep the sums of a stream's groups in a table that is merged when it is read.

    The totals so far are the query's state, one row for each group; a micro-batch updates those
    it touches, and writes these alone, one row for each group. A replayed micro-batch writes the
    same totals again.
    """
    totals = stream.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums))

    def take(changed: DataFrame, _: int) -> None:
        if table_exists(changed.sparkSession, table):
            DeltaTable(changed.sparkSession, table).take(changed, unique=True)
        else:
            DeltaTable.create(changed, table, by, unique=True)

    return _drained(totals, take, checkpoint, table, mode="update")


def table_stream(spark: SparkSession, table: str, load: str) -> DataFrame:
    """A table as a stream, stamped with the time and id of this load."""
    return spark.readStream.table(table).withColumns(
        {"_ingestion_ts": F.current_timestamp(), "_load_id": F.lit(load)}
    )
