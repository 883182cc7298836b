"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# AQE coalesces, splits skewed join partitions and switches to broadcast from
# measured sizes, so no plan in this library carries a hand-set partition count. It
# does not widen an aggregate, a window or a range sort: these start from
# ``initialPartitionNum`` and are merged to what the data needs. 2,000 partitions
# of 256 MB hold 500 GB between two shuffles; set more for more.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    A temporary folder of this machine is only taken in local mode, where
    driver and executors share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _own_root()


@cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="tillwork-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


# Fixed value: Spark's switch for dropping an execution's shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions that start inside leave no shuffle files when they end.

    Otherwise these stay until the driver's memory is collected, so that those of all steps of a
    long job lie on disk together. Meant for writes, whose shuffles nothing reads again.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _folder(spark: SparkSession, path: str):
    """Spark's view of a folder, on whatever store it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    store, place = _folder(spark, path)
    store.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly in ``path``, the newest first."""
    store, place = _folder(spark, path)
    if not store.exists(place):
        return []
    found = [f for f in store.listStatus(place) if f.isDirectory()]
    found.sort(key=lambda f: f.getModificationTime(), reverse=True)
    return [f.getPath().toString() for f in found]
