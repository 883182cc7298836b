"""Reading raw files and stamping where each row came from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .feeds import FEEDS, Feed, landing_table
from .sinks import append_rows, replace_table

# Reader options per text format.
READER_OPTIONS = {
    "csv": {
        "header": "true",
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    },
    "json": {"multiLine": "true"},
}


def source_path(root: str, path: str, directory: bool) -> str:
    """A single file as it is; a directory as all files directly in it."""
    full = path if path.startswith("/") or ":" in path else f"{root.rstrip('/')}/{path}"
    return f"{full}/*" if directory else full


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw files as a DataFrame; callers' options win over the defaults.

    With a schema nothing is inferred and no extra pass runs. Without one, CSV
    columns are inferred. A gzip or multi-line file is one task whatever its size;
    a ``rebalance`` hint on the result deals its rows out before heavy work, and large
    plain files are better read with ``multiLine`` off so that Spark splits them.
    """
    chosen = {**READER_OPTIONS.get(fmt, {}), **(options or {})}
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        chosen.setdefault("inferSchema", "true")
    return reader.options(**chosen).load(path)


def load_id(table: str, at: dt.datetime | None = None) -> str:
    # Fixed value: the format of the load id.
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"bronze:{table}:{at:%Y%m%d%H%M%S}"


def with_lineage(df: DataFrame, load: str, source: Column | str | None = None) -> DataFrame:
    """Ingest time, load id and source file. An existing source value is kept.

    The source is the file each row was read from unless one is given; a frame
    that does not come straight from files needs it given.
    """
    given = F.col("_metadata.file_path") if source is None else source
    given = F.lit(given) if isinstance(given, str) else given
    if "_source_file" in df.columns:
        given = F.coalesce(F.col("_source_file"), given)
    return df.withColumns(
        {
            "_ingestion_ts": F.current_timestamp(),
            "_load_id": F.lit(load),
            "_source_file": given,
        }
    )


def read_feed(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    path = source_path(root, feed.path, feed.directory)
    df = read_raw(spark, path, feed.fmt, feed.schema, feed.options)
    return with_lineage(df, load_id(feed.table))


def load_feed(spark: SparkSession, root: str, feed: Feed, schema_name: str) -> str:
    """One feed into its landing table: replaced if a snapshot, else appended."""
    table = f"{schema_name}.{landing_table(feed.table)}"
    write = replace_table if feed.snapshot else append_rows
    write(read_feed(spark, root, feed), table)
    return table


def load_all(
    spark: SparkSession, root: str, schema_name: str, feeds: tuple[Feed, ...] = FEEDS
) -> list[str]:
    """Every feed of the list; returns 'table <- path' lines."""
    return [f"{load_feed(spark, root, f, schema_name)} <- {f.path}" for f in feeds]
