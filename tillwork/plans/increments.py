"""Refining only what has landed since the last run.

A ledger, one table beside the refined ones, names for each landing table the loads that a finished
run has taken. A run finds the loads that are not in it, reads these alone, upserts them, and then
adds them to the ledger. If it stops in between, the next run takes the same loads again, which
leaves the refined table as it is.

A landing table that is partitioned by load id is pruned to the new loads, whose names come from
the catalog: a run without new loads reads no row. Of another table the load id column alone is
read to find them. A replaced snapshot is one load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.upsert import partition_columns, table_exists, upsert_table
from ..sources.feeds import Feed, landing_table
from ..sources.raw import load_id, read_raw, source_path, with_lineage
from ..sources.sinks import append_rows
from .entities import DELIVERY, ENTITIES, Entity
from .layers import Layers

LOAD = "_load_id"
LEDGER = "consumed_loads"


def loads_of(spark: SparkSession, table: str) -> DataFrame:
    """The ids of all loads of a landing table, as ``_load_id``."""
    if LOAD in partition_columns(spark, table):
        shown = spark.sql(f"SHOW PARTITIONS {table}")
        value = F.regexp_extract("partition", f"{LOAD}=([^/]*)", 1)
        return shown.select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(LOAD)).distinct()
    return spark.table(table).select(LOAD).distinct()


def ledger_of(spark: SparkSession, layers: Layers) -> DataFrame:
    name = f"{layers.refined}.{LEDGER}"
    if not table_exists(spark, name):
        return spark.createDataFrame([], f"table_name string, {LOAD} string, consumed_ts timestamp")
    return spark.table(name)


def new_loads(spark: SparkSession, layers: Layers, source: str) -> list[str]:
    """Loads of a landing table that no finished run has taken. Their number is that of the loads
    since then, not of rows."""
    taken = ledger_of(spark, layers).where(F.col("table_name") == source).select(LOAD)
    found = loads_of(spark, f"{layers.landing}.{source}").join(taken, LOAD, "left_anti")
    return sorted(r[0] for r in found.where(F.col(LOAD).isNotNull()).collect())


def commit_loads(spark: SparkSession, layers: Layers, source: str, loads: Sequence[str]) -> None:
    rows = spark.createDataFrame([(source, x) for x in loads], f"table_name string, {LOAD} string")
    append_rows(rows.withColumn("consumed_ts", F.current_timestamp()).coalesce(1), f"{layers.refined}.{LEDGER}")
    spark.catalog.refreshTable(f"{layers.refined}.{LEDGER}")


def land(spark: SparkSession, root: str, feed: Feed, schema_name: str, at: dt.datetime | None = None) -> str:
    """Append one load of a feed to its landing table, partitioned by load; returns the load id.

    Load ids have a resolution of seconds. A second load within one gets a number, so that a load
    never grows after a run has taken it.
    """
    table = f"{schema_name}.{landing_table(feed.table)}"
    load = wanted = load_id(feed.table, at)
    if table_exists(spark, table):
        taken = {r[0] for r in loads_of(spark, table).where(F.col(LOAD).startswith(wanted)).collect()}
        number = 1
        while load in taken:
            number += 1
            load = f"{wanted}-{number}"
    path = source_path(root, feed.path, feed.directory)
    # A load is one partition. Spark reads small files many to a task, so that they do not stay many.
    rows = with_lineage(read_raw(spark, path, feed.fmt, feed.schema, feed.options), load)
    append_rows(rows, table, [LOAD], gather=False)
    return load


def refine_new(
    spark: SparkSession,
    layers: Layers,
    entities: Sequence[Entity] = ENTITIES,
    threshold: float = q.DEFAULT_THRESHOLD,
) -> DataFrame | None:
    """Clean, check and upsert the new loads of every entity; None if there is nothing new.

    The checks judge what was new. Rows of the new loads with unreadable keys are left out; the
    whole run's ``refine`` sets them apart.
    """
    reports = []
    for entity in entities:
        source = f"{layers.landing}.{entity.source}"
        if not table_exists(spark, source):
            continue
        loads = new_loads(spark, layers, entity.source)
        if not loads:
            continue
        landed = spark.table(source).where(F.col(LOAD).isin(loads))

        def judge(batch: DataFrame, entity=entity) -> None:
            found = entity.checked(batch, threshold)
            reports.append(q.settled(found.withColumn("table_name", F.lit(entity.table))))

        table = f"{layers.refined}.{entity.table}"
        upsert_table(spark, entity.cleaned(landed, order=DELIVERY), table, entity.keys, unique=True, done=judge)
        commit_loads(spark, layers, entity.source, loads)
    if not reports:
        return None
    results = reports[0]
    for more in reports[1:]:
        results = results.unionByName(more)
    return results
