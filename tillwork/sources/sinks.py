"""Writers: snapshots, appends, clustered rewrites, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import settled
from ..operators.upsert import STORED, new_version, overwrite_partitions, partition_columns, point_to
from ..session import fresh_dir, remove


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")
    return name


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> str:
    """The table becomes exactly ``df``, schema included; repeating changes nothing."""
    _writer(df, partition_by).mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).saveAsTable(table)
    return table


def replace_with_valid(df: DataFrame, condition: Column, table: str) -> dict[str, int]:
    """The table becomes the rows that meet the condition; returns how many were ``kept`` and
    ``dropped``, counted while they are written, without a pass of their own."""
    seen, ok = Observation(), F.coalesce(condition, F.lit(False))
    counted = df.observe(seen, F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))
    replace_table(counted.where(ok), table)
    return seen.get


def append_rows(df: DataFrame, table: str, partition_by: Sequence[str] = (), gather: bool = True) -> str:
    """Adds the rows; a repeated load leaves copies for the key dedupe.

    Without ``gather`` every task writes the rows it has, which is meant for rows that all belong
    to one partition: they are in one place already, and need no shuffle.
    """
    _writer(df, partition_by, gather).mode("append").saveAsTable(table)
    return table


def _writer(df: DataFrame, partition_by: Sequence[str], gather: bool = True):
    if partition_by and gather:
        # One place per partition value, split again where a value is oversized.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").options(**STORED)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None):
    """Rewrite with rows range-ordered on ``columns``.

    Each file then covers a narrow range, so Parquet statistics skip files for
    filters on those columns. Ranges come from a sample; the content is whole.
    """
    ranged = df.repartitionByRange(*([files] if files else []), *columns)
    ranged.sortWithinPartitions(*columns).write.mode("errorifexists").parquet(path)
    return path


def recluster_table(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Compact and cluster a table.

    A table without partitions is written beside its old files and then switched to them. Of a
    partitioned one each partition is replaced by its rows in order, from a staged copy, so that
    the last step can be repeated.
    """
    parts = partition_columns(spark, table)
    if not parts:
        point_to(spark, table, write_clustered(spark.table(table), new_version(spark, table), columns))
        return
    staged = fresh_dir(spark, "recluster")
    spark.table(table).write.parquet(staged)
    ordered = [*parts, *(c for c in columns if c not in parts)]
    copy = spark.read.schema(spark.table(table).schema).parquet(staged)
    ranged = copy.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    overwrite_partitions(spark, ranged, table, parts)
    remove(spark, staged)


def _named(results: DataFrame) -> Column:
    parts = [F.col(c) for c in ("expectation_type", "name") if c in results.columns]
    return F.coalesce(*parts, F.lit(""))


def report_json(results: DataFrame, title: str) -> DataFrame:
    """All result rows as one JSON document. Results have one row per check."""
    rows = F.sort_array(F.collect_list(F.struct(*results.columns)))
    return results.agg(rows.alias("results")).select(
        F.to_json(
            F.struct(
                F.lit(title).alias("title"),
                F.current_timestamp().alias("generated_at"),
                F.col("results"),
            )
        ).alias("value")
    )


def report_markdown(results: DataFrame, title: str) -> DataFrame:
    """All result rows as one Markdown table with PASS or FAIL per check."""
    column = F.col("column") if "column" in results.columns else F.lit("")
    observed = F.col("observed") if "observed" in results.columns else F.lit("")
    verdict = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    line = F.concat(
        F.lit("| "), _named(results), F.lit(":"), F.coalesce(column, F.lit("")),
        F.lit(" | "), verdict, F.lit(" | "), F.coalesce(observed, F.lit("")), F.lit(" |"),
    )
    head = F.concat(
        F.lit(f"# {title}\n\nGenerated: "),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("  \n\n| check | passed | observed |\n|---|---|---|"),
    )
    body = F.array_join(F.sort_array(F.collect_list(line)), "\n")
    return results.agg(body.alias("body")).select(F.concat(head, F.lit("\n"), "body").alias("value"))


def write_report(results: DataFrame, path: str, title: str) -> tuple[str, str]:
    """The same results as JSON text and as Markdown under ``path``."""
    targets = (f"{path}/dq_results.json", f"{path}/dq_report.md")
    results = settled(results)
    for frame, target in zip(
        (report_json(results, title), report_markdown(results, title)), targets, strict=True
    ):
        frame.write.mode("overwrite").text(target)
    return targets
