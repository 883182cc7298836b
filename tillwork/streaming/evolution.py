"""Streams over files whose columns grow.

A log beside the checkpoint holds, for every delivered file, the columns of its header. Before a
drain the headers of files that are not in it are read, the stream is started with all columns that
any file has, and the target gets the ones it lacks: older rows hold NULL there. Columns that the
declared schema does not name are text, as their header says no more.

Fields of a file belong to columns by their place, so a wider file must begin with the columns of
the narrower ones; another one stops the run before anything is taken, and is named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import add_columns, table_exists
from ..session import subfolders
from .intake import drain_to_table, file_stream

LOGGED = "file string, columns array<string>"


class ColumnsMoved(ValueError):
    """A file's header does not begin with the columns that others have there."""


def _log(spark: SparkSession, log: str) -> DataFrame:
    if not subfolders(spark, log):
        return spark.createDataFrame([], LOGGED)
    return spark.read.schema(LOGGED).parquet(f"{log}/*")


def new_headers(spark: SparkSession, path: str, log: str, separator: str = ",") -> DataFrame:
    """``file`` and ``columns`` of files under ``path`` that the log lacks. Of these alone the text
    is read; the listing reads no content."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
    fresh = [r.file for r in listed.join(_log(spark, log), "file", "left_anti").collect()]
    if not fresh:
        return spark.createDataFrame([], LOGGED)
    first = (
        spark.read.text(fresh)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        .where("at = 0")
        .groupBy("file")
        .agg(F.first("value").alias("header"))
    )
    names = F.transform(F.split("header", f"[{separator}]"), lambda n: F.trim(F.replace(n, F.lit('"'), F.lit(""))))
    return first.select("file", names.alias("columns"))


def merged_columns(spark: SparkSession, log: str, declared: list[str]) -> list[str]:
    """The widest header, all others being its beginnings."""
    distinct = [r.columns for r in _log(spark, log).select("columns").distinct().collect()]
    widest = max([declared, *distinct], key=len)
    for columns in [declared, *distinct]:
        if widest[: len(columns)] != list(columns):
            odd = _log(spark, log).where(F.col("columns") == F.array(*map(F.lit, columns))).first()
            raise ColumnsMoved(f"{odd.file if odd else 'the declared schema'}: {columns} beside {widest}")
    return list(widest)


def drain_evolving(
    spark: SparkSession, path: str, schema: str, table: str, checkpoint: str, log: str
) -> list[str]:
    """Take everything that has arrived with all columns it has; returns the columns.

    ``schema`` declares the types of the columns known so far. A stop after the log was written
    and before the files were taken leaves a log that the next run reads.
    """
    known = spark.createDataFrame([], schema).schema
    headers = new_headers(spark, path, log)
    rows = headers.collect()  # one row per new file
    if rows:
        target = f"{log}/{len(subfolders(spark, log)):08d}"
        spark.createDataFrame(rows, LOGGED).coalesce(1).write.mode("overwrite").parquet(target)
    columns = merged_columns(spark, log, known.names)
    fields = [known[c] if c in known.names else T.StructField(c, T.StringType()) for c in columns]
    whole = T.StructType(fields)
    if table_exists(spark, table):
        add_columns(spark, table, spark.createDataFrame([], whole))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole)
    drain_to_table(file_stream(spark, path, ddl, table), table, checkpoint)
    spark.catalog.refreshTable(table)
    return columns
