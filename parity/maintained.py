"""Registered queries of tables that are maintained over several runs."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import functions as F

from tillwork.functions.retail_calendar import date_key
from tillwork.operators.clustering import zorder_table
from tillwork.operators.deltas import DeltaTable
from tillwork.operators.segments import balance_in_segments, closing_balances, continued
from tillwork.plans import declared, entities, increments, layers, star, store_days
from tillwork.session import fresh_dir
from tillwork.sources import feeds, sinks
from tillwork.streaming import evolution, intake, runs

from . import roles as r
from .queries import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    FEED_ROWS,
    LINE_SUM_COLUMNS,
    LINES_SQL,
    SALES_SPEC,
    SQL,
    STORE_DAY_SPEC,
    UPSERT_COLUMNS,
    UPSERT_SQL,
    landed_feeds,
    own_schema,
    query,
    upsert_sides,
    write_csv,
)


@query("zordered_rewrite", LINE_SUM_COLUMNS, LINES_SQL)
def _(spark, d):
    target = f"{own_schema(spark, 'zorder')}.lines"
    sinks.replace_table(r.lines(spark, d).withColumn("date_key", date_key("txn_date")), target)
    zorder_table(spark, target, ["store_key", "date_key", "product_key"])
    return spark.table(target)


@query("upsert_by_deltas", UPSERT_COLUMNS, UPSERT_SQL)
def _(spark, d):
    """Three batches, the second one taken again after a compaction; half the keys hold a NULL."""
    stored, batch = upsert_sides(spark, d)
    table = DeltaTable.create(stored, f"{own_schema(spark, 'deltas')}.orders", ["o_orderkey", "part_key"], buckets=16)
    table.take(batch.where("o_orderstatus = 'O'"))
    table.take(batch)
    table.compact()
    table.take(batch.unionByName(batch))
    return table.read()


LATE_SQL = """SELECT event_id, ts::DATE AS day, user_id, event_type,
    CASE WHEN ts::DATE >= '2024-01-16' THEN value + 1 ELSE value END AS value FROM events"""


def late_deliveries(spark, d, drain) -> None:
    """The corrected second half comes first, as delivery 2; then all events as delivery 1."""
    source, state = fresh_dir(spark, "late-in"), fresh_dir(spark, "late-state")
    events = r.event_days(spark, d)
    corrected = events.where("day >= '2024-01-16'").withColumn("value", F.col("value") + 1)
    for number, delivery in ((2, corrected), (1, events)):
        write = delivery.withColumn("delivery", F.lit(number)).write.mode("append")
        write.option("header", "true").csv(source)
        drain(intake.file_stream(spark, source, f"{EVENT_SCHEMA}, delivery int", "events"), state)


@query("late_delivery_loses", EVENT_COLUMNS, LATE_SQL)
def _(spark, d):
    """An older delivery that a later drain takes does not replace what is stored."""
    target = f"{own_schema(spark, 'late')}.events"
    late_deliveries(
        spark,
        d,
        lambda stream, state: intake.drain_to_upsert(stream, target, ["event_id"], state, versions=["delivery"]),
    )
    return spark.table(target)


@query("late_delivery_loses_in_deltas", EVENT_COLUMNS, LATE_SQL)
def _(spark, d):
    """The same with a table that is merged when it is read, compacted after each drain."""
    target = f"{own_schema(spark, 'late-deltas')}.events"
    late_deliveries(
        spark,
        d,
        lambda stream, state: intake.drain_to_deltas(
            stream, target, ["event_id"], state, ["delivery"], compact_after=1
        ),
    )
    return spark.table(target)


@query(
    "refine_only_new_loads",
    SALES_SPEC + " runs:i loads:i",
    """SELECT * REPLACE (CASE WHEN store_key % 2 = 1 AND product_key % 7 = 0 THEN unit_qty + 1
        ELSE unit_qty END AS unit_qty), 2 AS runs, 2 AS loads FROM sales""",
)
def _(spark, d):
    """Two loads, the second one with corrections of the first, each refined by its own run; a third
    run finds nothing."""
    feed = feeds.FEEDS[3]
    names = layers.Layers(*[own_schema(spark, f"new-{x}") for x in ("raw", "ref", "star")])
    sales = r.daily_sales(spark, d)
    odd = sales.where("store_key % 2 = 1")
    corrected = odd.where("product_key % 7 = 0").withColumn("unit_qty", F.col("unit_qty") + 1)
    finished = 0
    for load in (odd, corrected.unionByName(sales.where("store_key % 2 = 0")), None):
        if load is not None:
            root = fresh_dir(spark, "load")
            columns = [f.name for f in spark.createDataFrame([], feed.schema).schema]
            write_csv(load.select(*columns), f"{root}/{feed.path}")
            increments.land(spark, root, feed, names.landing, dt.datetime(2025, 1, 1))
        done = increments.refine_new(spark, names, (entities.DAILY_SALES,))
        finished += done is not None
    ledger = increments.ledger_of(spark, names).agg(F.count("*").alias("loads"))
    return spark.table(f"{names.refined}.sil_daily_sales").withColumn("runs", F.lit(finished)).join(ledger)


@query(
    "feeds_landed_by_stream",
    "table_name:s rows:i added_again:i",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {b}) AS rows, 0 AS added_again"
        for t, b in {**FEED_ROWS, "brz_sales_daily_store_sku": "sales"}.items()
    ),
)
def _(spark, d):
    """All feeds in one run, the daily ones as streams; the second run adds nothing."""
    root, listed = landed_feeds(spark, d)
    target, state = own_schema(spark, "by-stream"), fresh_dir(spark, "by-stream-state")
    runs.take_feeds(spark, root, target, state, listed)
    again = {x.table: x.rows or 0 for x in runs.take_feeds(spark, root, target, state, listed)}
    parts = [
        spark.table(table).agg(F.count("*").alias("rows")).select(
            F.lit(table.rpartition(".")[2]).alias("table_name"), "rows", F.lit(rows).alias("added_again")
        )
        for table, rows in again.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "stream_takes_wider_files",
    EVENT_COLUMNS + " columns:i",
    """SELECT event_id, ts::DATE AS day, user_id, event_type,
       CASE WHEN ts::DATE >= '2024-01-16' THEN value END AS value, 5 AS columns FROM events""",
)
def _(spark, d):
    """Files with a further column from the second drain on; the schema names only the first four."""
    source, state, log = (fresh_dir(spark, f"wider-{x}") for x in ("in", "state", "log"))
    target = f"{own_schema(spark, 'wider')}.events"
    events = r.event_days(spark, d)
    narrow = events.where("day < '2024-01-16'").drop("value")
    for delivery in (narrow, events.where("day >= '2024-01-16'")):
        delivery.write.mode("append").option("header", "true").csv(source)
        columns = evolution.drain_evolving(
            spark, source, "event_id bigint, day date, user_id bigint, event_type string", target, state, log
        )
    taken = spark.table(target).withColumn("value", F.col("value").cast("double"))
    return taken.withColumn("columns", F.lit(len(columns)))


@query(
    "declared_rollup_stream",
    "date_key:i store_key:i net_sales:d unit_qty:i commerce_period:s mtd_sales:d ytd_sales:d",
    SQL["declared_chain_from_stream"],
)
def _(spark, d):
    """The store days of the declared chain kept by a stream over three deliveries."""
    name, state = own_schema(spark, "rollup"), fresh_dir(spark, "rollup-state")
    sales = r.daily_sales(spark, d)
    for k in range(3):
        # Each delivery holds lines of most store days.
        sinks.append_rows(sales.where(F.col("product_key") % 3 == k), f"{name}.raw_sales")
        stream = declared.gated_sales(spark.readStream.table(f"{name}.raw_sales"))
        intake.drain_rollup(stream, ["date_key", "store_key"], ["net_sales", "unit_qty"], f"{name}.days", state)
    return declared.store_day(spark.table(f"{name}.days"), r.calendar(spark, d))


@query(
    "rows_counted_while_written",
    "kept:i dropped:i stored:i",
    """SELECT count(*) FILTER (o_orderstatus <> 'P') AS kept, count(*) FILTER (o_orderstatus = 'P') AS dropped,
       count(*) FILTER (o_orderstatus <> 'P') AS stored FROM orders""",
)
def _(spark, d):
    """Rows that a condition keeps and drops, counted by the job that writes them."""
    target = f"{own_schema(spark, 'observed')}.orders"
    condition = F.when(F.col("o_orderstatus") != "P", F.lit(True))
    seen = sinks.replace_with_valid(r.table(spark, d, "orders"), condition, target)
    stored = spark.table(target).agg(F.count("*").alias("stored"))
    return stored.withColumns({c: F.lit(n) for c, n in seen.items()})


LEDGER_SPEC = "date_key:i store_key:i product_key:i on_hand_qty:i"
LEDGER_SQL = "SELECT date_key, store_key, product_key, on_hand_qty FROM inventory"


def ledger_parts() -> dict:
    return {
        "entity": ["store_key", "product_key"],
        "order": "date_key",
        "flow": F.expr("received_qty - coalesce(sold_qty, 0) + adjusted_qty"),
        "base": F.expr("(store_key * 7 + product_key * 3) % 31"),
        "out": "on_hand_qty",
        "segment": F.floor(F.col("date_key") / 100),
    }


@query("inventory_ledger_in_segments", LEDGER_SPEC, LEDGER_SQL)
def _(spark, d):
    """The stock ledger with months as segments, which are summed up apart."""
    return balance_in_segments(r.flows(spark, d), **ledger_parts())


@query("inventory_ledger_continued", LEDGER_SPEC, LEDGER_SQL)
def _(spark, d):
    """Days before 1996, and then the later ones from the stored closing balances alone."""
    name, parts = own_schema(spark, "ledger"), ledger_parts()
    flows = r.flows(spark, d)
    first = f"{name}.ledger"
    sinks.replace_table(balance_in_segments(flows.where("date_key < 19960101"), **parts), first)
    closing = closing_balances(spark.table(first), parts["entity"], parts["order"], parts["out"])
    sinks.replace_table(closing, f"{name}.state")
    added, _ = continued(spark.table(f"{name}.state"), flows.where("date_key >= 19960101"), **parts)
    return spark.table(first).unionByName(added)


@query("store_days_from_buckets", STORE_DAY_SPEC + " net_sales_mc:d mc_variation_pct:d", "SELECT * FROM fact_store_day")
def _(spark, d):
    """The fact from stored store days, which lie in buckets of stores."""
    table = f"{own_schema(spark, 'buckets')}.store_days"
    sales = r.sales_lines(spark, d)
    base = star.store_day_base(sales, r.stores(spark, d), r.sold_tickets(spark, d))
    store_days.write_store_days(base, table, buckets=store_days.buckets_for(sales))
    return store_days.fact_of_stored(spark.table(table), month_close=True)


@query("store_days_corrected", STORE_DAY_SPEC + " net_sales_mc:d mc_variation_pct:d", "SELECT * FROM fact_store_day")
def _(spark, d):
    """Every third store lacks some lines of spring 1996 and has some of 1997 twice; the stored fact
    is then corrected where that reaches."""
    table = f"{own_schema(spark, 'corrected')}.store_days"
    sales, stores, tickets = r.sales_lines(spark, d), r.stores(spark, d), r.sold_tickets(spark, d)
    odd = F.col("store_key") % 3 == 1
    late = odd & F.col("date_key").between(19960401, 19960531) & (F.col("product_key") % 2 == 0)
    twice = odd & F.col("date_key").between(19970215, 19970310) & (F.col("product_key") % 5 == 0)
    first = sales.where(~late).unionByName(sales.where(twice))
    buckets = store_days.buckets_for(sales, dealt=True)
    fact = star.fact_store_day(first, stores, tickets, month_close=True, buckets=buckets)
    store_days.write_store_days(fact, table, buckets=buckets, dealt=True)
    store_days.correct_store_days(spark, table, sales.where(late | twice), sales, stores, tickets)
    return spark.table(table)
