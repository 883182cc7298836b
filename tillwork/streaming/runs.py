"""A manifest of feeds taken in one run, the daily ones as streams.

Every daily feed is a query with a checkpoint of its own, and all of them run at the same time;
a second run takes only what has arrived since. Snapshots replace their tables as a batch. A feed
that fails does not stop the others: the run ends when all have, and then reports the first failure
under the feed's name, so that a repeat takes up what is missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.feeds import FEEDS, Feed, landing_table
from ..sources.raw import load_feed
from ..sources.sinks import STORED
from .intake import feed_stream


class FeedFailure(RuntimeError):
    """A feed of a run did not end well; ``feed`` is its name."""

    def __init__(self, feed: str, cause: BaseException):
        super().__init__(f"{feed}: {cause}")
        self.feed = feed


@dataclass(frozen=True)
class Taken:
    """What a run did with a feed: the rows a stream took, in as many of its last micro-batches as
    Spark keeps the progress of, or None for a replaced snapshot."""

    feed: str
    table: str
    rows: int | None


def _added(query: StreamingQuery) -> int:
    return sum(p.numInputRows for p in query.recentProgress)


def take_feeds(
    spark: SparkSession,
    root: str,
    schema_name: str,
    checkpoints: str,
    feeds: tuple[Feed, ...] = FEEDS,
    max_files: int | None = None,
) -> list[Taken]:
    """All feeds of the list, once. ``checkpoints`` is a folder that outlives the runs."""
    started: list[tuple[Feed, str, StreamingQuery]] = []
    failures: list[FeedFailure] = []
    done: list[Taken] = []
    for feed in feeds:
        table = f"{schema_name}.{landing_table(feed.table)}"
        try:
            if feed.snapshot:
                load_feed(spark, root, feed, schema_name)
                done.append(Taken(feed.table, table, None))
                continue
            query = (
                feed_stream(spark, root, feed, max_files)
                .writeStream.outputMode("append")
                .format("parquet")
                .options(**STORED)
                .queryName(feed.table)
                .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{feed.table}")
                .trigger(availableNow=True)
                .toTable(table)
            )
            started.append((feed, table, query))
        except Exception as cause:  # reported below, under the feed's name
            failures.append(FeedFailure(feed.table, cause))
    for feed, table, query in started:
        try:
            query.awaitTermination()
            done.append(Taken(feed.table, table, _added(query)))
        except StreamingQueryException as cause:
            failures.append(FeedFailure(feed.table, cause))
    if failures:
        names = [f.table for f in feeds]
        first = min(failures, key=lambda f: names.index(f.feed))
        raise first
    return done
