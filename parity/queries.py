"""Registered queries: one per operator, on the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import cleaning as c
from tillwork.functions import measures as m
from tillwork.functions.retail_calendar import attach_calendar, date_key, day_of_key
from tillwork.operators import dedupe, joins, quality, rollups, running
from tillwork.operators import balances as bal
from tillwork.operators.calendar import commerce_calendar
from tillwork.operators.columns import at_latest, cast_keys, cast_money, keys_first, up_to
from tillwork.operators.upsert import merged, upsert_partitions, upsert_table
from tillwork.plans import dashboards, declared, entities, layers, star
from tillwork.session import fresh_dir, remove, shuffles_dropped
from tillwork.sources import feeds, raw, sinks
from tillwork.streaming import intake

from . import roles as r
from .sql import calendar_of, first_per, half_up, statement

Query = Callable[[SparkSession, str], DataFrame]
SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string", "b": "boolean"}

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, columns: str, sql: str | None):
    """Register a query with its result columns and the SQL that must agree."""

    def register(fn: Query) -> Query:
        def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            picks = [c.split(":") for c in columns.split()]
            return df.select(*[F.col(f"`{n}`").cast(SPARK_TYPES[t]).alias(n) for n, t in picks])

        QUERIES[name] = shaped
        if sql is not None:
            SQL[name] = statement(columns, sql)
        return fn

    return register


def own_schema(spark: SparkSession, label: str) -> str:
    """A new catalog schema whose tables lie in the shared folder."""
    location = fresh_dir(spark, label)
    return sinks.create_schema(spark, location.rsplit("/", 1)[1].replace("-", "_"), location)


# ---- sources and sinks ------------------------------------------------------

ORDER_COLUMNS = (
    "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d o_orderdate:s o_orderpriority:s"
)
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders"""
EVENT_COLUMNS = "event_id:i day:s user_id:i event_type:s value:d"
EVENTS_SQL = "SELECT event_id, ts::DATE AS day, user_id, event_type, value FROM events"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )


def write_csv(df: DataFrame, path: str, gzip: bool = True) -> str:
    writer = df.write.option("header", "true").option("emptyValue", "")
    if gzip:
        # The default level takes twice the time for files that are a seventh smaller.
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path)
    return path


@query(
    "csv_gzip_load_with_lineage",
    ORDER_COLUMNS + " note:s load_kind:s from_gzip:b stamped:b",
    """SELECT *, o_orderstatus || chr(10) || o_orderpriority AS note,
       'bronze:orders' AS load_kind, true AS from_gzip, true AS stamped
       FROM (""" + ORDERS_SQL + ")",
)
def _(spark, d):
    noted = orders(spark, d).withColumn(
        "note", F.concat("o_orderstatus", F.lit("\n"), "o_orderpriority")
    )
    path = write_csv(noted, fresh_dir(spark, "orders-csv"))
    schema = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate date, o_orderpriority string, note string"""
    loaded = raw.with_lineage(
        raw.read_raw(spark, raw.source_path(path, path, True), "csv", schema),
        raw.load_id("orders"),
    ).hint("rebalance")
    return loaded.withColumns(
        {
            "load_kind": F.substring_index("_load_id", ":", 2),
            "from_gzip": F.col("_source_file").endswith(".csv.gz"),
            "stamped": F.col("_ingestion_ts").isNotNull(),
        }
    )


@query("json_lines_load", EVENT_COLUMNS, EVENTS_SQL)
def _(spark, d):
    path = fresh_dir(spark, "events-json")
    r.event_days(spark, d).write.json(path)
    schema = "event_id bigint, day date, user_id bigint, event_type string, value double"
    return raw.read_raw(spark, path, "json", schema, {"multiLine": "false"})


@query(
    "source_file_lineage",
    "o_orderstatus:s from_orders:b kept:b rows:i",
    """SELECT o_orderstatus, o_orderstatus <> 'P' AS from_orders, o_orderstatus = 'P' AS kept,
       count(*) AS rows FROM orders GROUP BY ALL""",
)
def _(spark, d):
    seen = orders(spark, d).withColumn(
        "_source_file", F.when(F.col("o_orderstatus") == "P", F.lit("earlier.csv"))
    )
    tracked = raw.with_lineage(seen, raw.load_id("orders"))
    return tracked.groupBy(
        "o_orderstatus",
        F.col("_source_file").contains("orders.parquet").alias("from_orders"),
        (F.col("_source_file") == "earlier.csv").alias("kept"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("snapshot_replace_twice", EVENT_COLUMNS, EVENTS_SQL)
def _(spark, d):
    target = f"{own_schema(spark, 'snapshot')}.events"
    sinks.replace_table(r.event_days(spark, d).select("event_id", "day"), target)
    # The second snapshot also brings a wider schema.
    sinks.replace_table(r.event_days(spark, d), target)
    return spark.table(target)


@query("append_twice_then_dedupe", ORDER_COLUMNS, ORDERS_SQL)
def _(spark, d):
    target = f"{own_schema(spark, 'append')}.orders"
    for _ in range(2):
        sinks.append_rows(orders(spark, d), target)
    return dedupe.keep_first(spark.table(target), ["o_orderkey"])


UPSERT_COLUMNS = "o_orderkey:i part_key:s o_orderstatus:s o_totalprice:d"
UPSERT_SQL = """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS part_key, o_orderstatus,
    CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice
    FROM orders"""


def upsert_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Stored orders (F, O), and a batch that changes O and brings P; half the keys
    have a NULL part."""
    keyed = orders(spark, d).selectExpr(
        "o_orderkey", "nullif(o_orderpriority, '5-LOW') part_key", "o_orderstatus", "o_totalprice"
    )
    doubled = keyed.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return keyed.where("o_orderstatus <> 'P'"), doubled.where("o_orderstatus <> 'F'")


@query("upsert_by_null_safe_key", UPSERT_COLUMNS, UPSERT_SQL)
def _(spark, d):
    target = f"{own_schema(spark, 'upsert')}.orders"
    stored, batch = upsert_sides(spark, d)
    for rows in (stored, batch, batch.unionByName(batch)):
        upsert_table(spark, rows, target, ["o_orderkey", "part_key"])
    return spark.table(target)


@query("upsert_touched_partitions", ORDER_COLUMNS + " year:i", """
    SELECT * REPLACE (CASE WHEN year(o_orderdate) >= 1999 THEN o_totalprice * 2
        ELSE o_totalprice END AS o_totalprice), year(o_orderdate) AS year
    FROM (""" + ORDERS_SQL + ")")
def _(spark, d):
    root = fresh_dir(spark, "orders-by-year")
    dated = orders(spark, d).withColumn("year", F.year("o_orderdate"))
    keys_first(dated, ["year", "o_orderkey"]).write.partitionBy("year").parquet(root)
    newer = dated.where("year >= 1999").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    upsert_partitions(spark, newer, root, ["year", "o_orderkey"], "year", unique=True)
    return spark.read.parquet(root)


@query("upsert_into_partitioned_table", UPSERT_COLUMNS + " year:i", """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS part_key, o_orderstatus,
        CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice,
        nullif(year(o_orderdate), 1998) AS year FROM orders""")
def _(spark, d):
    """Updates, inserts and NULL keys in a table partitioned by year, one year being NULL."""
    target = f"{own_schema(spark, 'upsert-years')}.orders"
    dated = orders(spark, d).selectExpr(
        "o_orderkey", "nullif(o_orderpriority, '5-LOW') part_key", "o_orderstatus",
        "o_totalprice", "nullif(year(o_orderdate), 1998) year",
    )
    sinks.replace_table(dated.where("o_orderstatus <> 'P'"), target, ["year"])
    batch = dated.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        upsert_table(spark, batch, target, ["o_orderkey", "part_key"])
    return spark.table(target)


@query("upsert_narrow_batch", UPSERT_COLUMNS, """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS part_key,
        CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE floor(o_totalprice) END AS o_totalprice
    FROM orders""")
def _(spark, d):
    """A batch without the status and with whole prices: stored values and types stay."""
    target = f"{own_schema(spark, 'upsert-narrow')}.orders"
    stored, batch = upsert_sides(spark, d)
    upsert_table(spark, stored, target, ["o_orderkey", "part_key"])
    whole = batch.select("o_orderkey", "part_key", F.floor(F.col("o_totalprice") / 2).alias("o_totalprice"))
    upsert_table(spark, whole, target, ["o_orderkey", "part_key"])
    return spark.table(target)


@query("corrected_delivery_wins", UPSERT_COLUMNS, """
    SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS part_key, o_orderstatus,
        CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE o_totalprice / 2 END AS o_totalprice
    FROM orders""")
def _(spark, d):
    """Two deliveries in one landing table; the later one has the smaller values and wins."""
    target = f"{own_schema(spark, 'corrected')}.orders"
    keyed = orders(spark, d).selectExpr(
        "o_orderkey", "nullif(o_orderpriority, '5-LOW') part_key", "o_orderstatus", "o_totalprice"
    )
    later = keyed.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    landed = keyed.withColumn("_ingestion_ts", F.timestamp_seconds(F.lit(1))).unionByName(
        later.withColumn("_ingestion_ts", F.timestamp_seconds(F.lit(2)))
    )
    upsert_table(spark, landed, target, ["o_orderkey", "part_key"], order=entities.DELIVERY[:1])
    return spark.table(target)


@query(
    "rejected_rows",
    "product_key:s kept:i rejected:i",
    """SELECT 'p' || p_partkey AS product_key,
       (SELECT count(*) FROM part WHERE p_partkey % 9 <> 4) AS kept,
       count(*) OVER () AS rejected FROM part WHERE p_partkey % 9 = 4""",
)
def _(spark, d):
    """Products whose key is no number: each keeps its raw text, none merges with another."""
    broken = F.expr("case when cast(product_key as int) % 9 = 4 then concat('p', product_key) else product_key end")
    raw_rows = r.raw_products(spark, d).withColumn("product_key", broken)
    bad = entities.PRODUCT.rejected(raw_rows)
    counts = entities.PRODUCT.cleaned(raw_rows).agg(F.count("*").alias("kept")).join(
        bad.agg(F.count("*").alias("rejected"))
    )
    return bad.select("product_key").join(counts)


@query(
    "calendar_between",
    "date_key:i date_value:s days:i",
    """SELECT year(day) * 10000 + month(day) * 100 + day(day) AS date_key, day AS date_value,
       count(*) OVER () AS days FROM (
        SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders),
            (SELECT max(o_orderdate)::DATE FROM orders), INTERVAL 1 DAY))::DATE AS day)""",
)
def _(spark, d):
    """The start and end form, with the bounds of the orders given the wrong way round."""
    low, high = orders(spark, d).agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    days = commerce_calendar(spark, high, low)
    return days.select("date_key", "date_value").join(days.agg(F.count("*").alias("days")))


@query(
    "own_entity",
    "kind:s name:s value:i",
    """SELECT 'rows' AS kind, o_orderpriority AS name, count(*) AS value FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY ALL
       UNION ALL SELECT 'passed', 'o_orderkey', 1
       UNION ALL SELECT 'passed', 'o_orderstatus', (SELECT (count(DISTINCT o_orderstatus) = 2)::INT
           FROM orders WHERE o_orderstatus <> 'P' AND o_orderstatus IN ('O', 'P'))""",
)
def _(spark, d):
    """An entity with a user's own cleaner and checks."""
    own = entities.Entity(
        source="orders",
        table="open_orders",
        keys=("o_orderkey",),
        rules={},
        checks=(quality.not_null("o_orderkey"), quality.contains("o_orderstatus", ["O", "P"])),
        clean=lambda df: df.where("o_orderstatus <> 'P'"),
    )
    rows = own.cleaned(orders(spark, d))
    counted = rows.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("value"))
    judged = own.checked(rows).where(F.col("column").isin("o_orderkey", "o_orderstatus"))
    return counted.select(F.lit("rows").alias("kind"), "name", "value").unionByName(
        judged.select(F.lit("passed").alias("kind"), F.col("column").alias("name"), F.col("passed").cast("bigint").alias("value"))
    )


@query(
    "key_first_projection",
    "columns:s rows:i",
    """SELECT 'o_custkey,o_orderkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority,'
       || 'sil_updated_ts' AS columns, count(*) AS rows FROM orders""",
)
def _(spark, d):
    tracked = raw.with_lineage(orders(spark, d), raw.load_id("orders"))
    out = keys_first(tracked, ["o_custkey", "o_orderkey"])
    return out.agg(F.lit(",".join(out.columns)).alias("columns"), F.count("*").alias("rows"))


LINE_SUM_COLUMNS = "date_key:i store_key:i product_key:i unit_qty:i net_amount:d"
LINES_SQL = "SELECT date_key, store_key, product_key, unit_qty, net_amount FROM lines"


@query("clustered_rewrite", LINE_SUM_COLUMNS, LINES_SQL)
def _(spark, d):
    target = f"{own_schema(spark, 'cluster')}.lines"
    dated = r.lines(spark, d).withColumn("date_key", date_key("txn_date"))
    sinks.replace_table(dated, target)
    sinks.recluster_table(spark, target, ["store_key", "date_key"])
    return spark.table(target)


# ---- typed and cleaned entities ---------------------------------------------


@query(
    "bulk_casts",
    "txn_id:i line_id:i unit_qty:i gross:d",
    """SELECT l_orderkey AS txn_id, l_linenumber AS line_id,
       CASE WHEN l_quantity <> 50 THEN l_quantity END AS unit_qty, l_extendedprice AS gross
       FROM lineitem""",
)
def _(spark, d):
    keyed = cast_keys(r.raw_lines(spark, d), ["txn_id", "line_id", "unit_qty"])
    return cast_money(keyed, ["gross_amount"]).withColumnRenamed("gross_amount", "gross")


@query(
    "clean_store",
    "store_key:i store_code:s name:s chain_format:s region:s city:s address:s open_m2:i "
    "open_date:s status:s",
    """SELECT * FROM (""" + first_per(
        """(SELECT store_key, store_code, name, chain_format, region, city, address,
            CASE WHEN store_key % 11 <> 3 THEN open_m2 END AS open_m2,
            CASE WHEN store_key % 13 <> 4 THEN open_date END AS open_date,
            CASE WHEN status IN ('Active', 'Planned') THEN status ELSE 'Unknown' END AS status
            FROM (SELECT * FROM stores UNION ALL
                SELECT * REPLACE ('A ' || name AS name, 'Planned' AS status)
                FROM stores WHERE store_key % 3 = 0))""",
        "store_key", "store_code, name",
    ) + ")",
)
def _(spark, d):
    return entities.STORE.cleaned(r.raw_stores(spark, d))


PRODUCT_SPEC = (
    "product_key:i sku:s ean:s name:s brand:s category:s dept:s retail_price:d unit_cost:d "
    "uom:s barcode_weight_kg:d"
)


@query(
    "clean_product",
    PRODUCT_SPEC,
    """SELECT * REPLACE (lpad(ean, 13, '0') AS ean,
       CASE WHEN product_key % 19 <> 7 THEN unit_cost END AS unit_cost) FROM products""",
)
def _(spark, d):
    return entities.PRODUCT.cleaned(r.raw_products(spark, d))


CALENDAR_SPEC = (
    "date_key:i date_value:s commerce_year:i commerce_quarter:i commerce_month:i "
    "commerce_period:s commerce_week:i quarter_week:i iso_year:i iso_week:i day_of_week:i "
    "day_name:s is_weekend:b date_key_sss:i date_key_mc:i"
)


@query("clean_calendar", CALENDAR_SPEC.replace("is_weekend:b", "is_weekend:s"),
       "SELECT * REPLACE (is_weekend::VARCHAR AS is_weekend) FROM calendar")
def _(spark, d):
    text = r.calendar(spark, d)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    return entities.CALENDAR.cleaned(text.unionByName(text))


SALES_SPEC = (
    "date_key:i store_key:i product_key:i sku:s unit_qty:i gross_sales:d net_sales:d "
    "discount_amount:d tax_amount:d cost_amount:d ticket_count:i line_count:i promo_line_count:i"
)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("clean_daily_sales", SALES_SPEC, "SELECT * FROM sales")
def _(spark, d):
    text = as_text(r.daily_sales(spark, d))
    return entities.DAILY_SALES.cleaned(text.unionByName(text))


@query(
    "clean_pos_line",
    "txn_id:s line_id:i txn_date:s store_key:i product_key:i sku:s unit_qty:i gross_amount:d "
    "discount_amount:d net_amount:d tax_amount:d cost_amount:d payment_type:s channel:s is_promo:b",
    first_per(
        """(SELECT l_orderkey::VARCHAR AS txn_id, l_linenumber AS line_id,
            l_shipdate::DATE AS txn_date, l_suppkey AS store_key, l_partkey AS product_key,
            'SKU-' || l_partkey AS sku, CASE WHEN l_quantity <> 50 THEN l_quantity::INT END
            AS unit_qty, l_extendedprice::DECIMAL(18,4) AS gross_amount,
            l_discount::DECIMAL(18,4) AS discount_amount,
            CASE WHEN l_tax <> 0 THEN l_extendedprice::DECIMAL(18,4) END AS net_amount,
            l_tax::DECIMAL(18,4) AS tax_amount, 1.5 AS cost_amount,
            CASE WHEN l_linestatus = 'O' THEN 'CARD' ELSE 'CASH' END AS payment_type,
            upper(l_returnflag) AS channel,
            CASE WHEN l_discount > 0.055 THEN true WHEN l_discount > 0.005 THEN false END
            AS is_promo FROM lineitem)""",
        "txn_id, line_id",
        "txn_date, store_key, product_key, sku, unit_qty, gross_amount, discount_amount, "
        "net_amount, tax_amount, cost_amount, payment_type, channel, is_promo",
    ),
)
def _(spark, d):
    return entities.POS_LINE.cleaned(r.raw_lines(spark, d))


@query(
    "clean_store_kpi",
    "date_key:i store_key:i ticket_count:i transaction_count:i avg_basket:d traffic_estimate:i "
    "sales_m2:d gross_sales:d net_sales:d",
    "SELECT * FROM kpi",
)
def _(spark, d):
    return entities.STORE_KPI.cleaned(as_text(r.store_kpi(spark, d)))


INVENTORY_SPEC = (
    "date_key:i store_key:i product_key:i sku:s on_hand_qty:i on_hand_cost:d received_qty:i "
    "sold_qty:i adjusted_qty:i in_transit_qty:i stock_state:s unit_cost:d retail_price:d"
)


@query(
    "clean_inventory",
    INVENTORY_SPEC,
    """SELECT * REPLACE (CASE WHEN on_hand_qty % 5 = 0 THEN 'UNKNOWN' ELSE stock_state END
       AS stock_state) FROM inventory""",
)
def _(spark, d):
    spoiled = F.expr(
        "case on_hand_qty % 10 when 0 then 'MISSING' when 5 then null else stock_state end"
    )
    text = as_text(r.inventory(spark, d).withColumn("stock_state", spoiled))
    return entities.INVENTORY.cleaned(text)


BUDGET_SPEC = (
    "commerce_period:s calendar_month_start:s store_key:i dept:s budget_amount:d "
    "budget_qty_units:i"
)


@query("clean_budget", BUDGET_SPEC, "SELECT * FROM budget")
def _(spark, d):
    text = as_text(r.budget(spark, d))
    return entities.BUDGET.cleaned(
        text.withColumn("dept", F.concat(F.lit("  "), F.lower("dept"), F.lit(" ")))
    )


@query(
    "enum_with_fallback",
    "o_orderkey:i status:s",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN 'OTHER'
       ELSE o_orderstatus END AS status FROM orders""",
)
def _(spark, d):
    gaps = orders(spark, d).withColumn(
        "status", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    )
    return gaps.select("o_orderkey", c.one_of(["F", "O"], "OTHER")("status").alias("status"))


@query(
    "text_functions",
    "o_orderkey:i code:s title:s padded:s first_known:s",
    """SELECT o_orderkey, upper(trim(o_orderpriority)) AS code,
       CASE o_orderstatus WHEN 'F' THEN 'Fully Filled' WHEN 'O' THEN 'Still Open' END AS title,
       CASE WHEN length(o_custkey::VARCHAR) < 4 THEN lpad(o_custkey::VARCHAR, 4, '0')
           ELSE o_custkey::VARCHAR END AS padded,
       coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS first_known FROM orders""",
)
def _(spark, d):
    spoken = F.expr(
        "case o_orderstatus when 'F' then ' fully FILLED' when 'O' then 'STILL open ' end"
    )
    o = orders(spark, d).withColumn("spoken", spoken)
    return o.select(
        "o_orderkey",
        c.code("o_orderpriority").alias("code"),
        c.title("spoken").alias("title"),
        c.left_padded(4)("o_custkey").alias("padded"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("first_known"),
    )


# ---- dimensions, cutoffs, dedupe --------------------------------------------

STORE_SPEC = (
    "store_key:i store_code:s name:s chain_format:s region:s city:s address:s open_m2:i "
    "open_date:s status:s"
)


@query("dimension_store", STORE_SPEC, "SELECT * FROM stores")
def _(spark, d):
    stored = f"{own_schema(spark, 'dims')}.dim_store"
    return spark.table(sinks.replace_table(star.dim_store(r.stores(spark, d)), stored))


@query("dimension_product", PRODUCT_SPEC, "SELECT * FROM products")
def _(spark, d):
    return star.dim_product(r.products(spark, d))


@query(
    "dimension_calendar", CALENDAR_SPEC.replace("iso_year:i ", ""), "SELECT * FROM calendar"
)
def _(spark, d):
    return star.dim_calendar(r.calendar(spark, d))


STORE_DAY_SUMS = (
    "date_key:i store_key:i unit_qty:i gross_sales:d net_sales:d discount_amount:d "
    "tax_amount:d cost_amount:d promo_line_count:i"
)


@query("store_day_rollup", STORE_DAY_SUMS, "SELECT * FROM store_day")
def _(spark, d):
    return rollups.store_day(r.sales_lines(spark, d))


@query(
    "as_of_cutoff", STORE_DAY_SUMS, "SELECT * FROM store_day WHERE date_key <= 19981231"
)
def _(spark, d):
    return rollups.store_day(up_to(r.sales_lines(spark, d), "1998-12-31"))


@query(
    "latest_day_rows",
    LINE_SUM_COLUMNS,
    LINES_SQL + " WHERE date_key = (SELECT max(date_key) FROM lines)",
)
def _(spark, d):
    dated = r.lines(spark, d).withColumn("date_key", date_key("txn_date"))
    return at_latest(dated.select("date_key", "store_key", "product_key", "unit_qty", "net_amount"))


DEDUPE_SPEC = "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:d price:d shipped:s"
DEDUPE_SOURCE = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice AS price, l_shipdate::DATE AS shipped FROM lineitem)"""


def order_lines(spark, d) -> DataFrame:
    return r.lineitem(spark, d).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice price", "cast(l_shipdate as date) shipped",
    )


@query(
    "dedupe_by_key",
    DEDUPE_SPEC,
    first_per(
        DEDUPE_SOURCE, "l_orderkey, l_linenumber", "l_partkey, l_suppkey, l_quantity, price, shipped"
    ),
)
def _(spark, d):
    return dedupe.keep_first(order_lines(spark, d), ["l_orderkey", "l_linenumber"])


@query(
    "keep_first_in_order",
    DEDUPE_SPEC,
    first_per(
        DEDUPE_SOURCE, "l_orderkey, l_linenumber", "shipped, price, l_partkey, l_suppkey, l_quantity"
    ),
)
def _(spark, d):
    lines = order_lines(spark, d)
    return dedupe.keep_first(lines, ["l_orderkey", "l_linenumber"], ["shipped", "price"])


@query(
    "keep_last_in_order",
    DEDUPE_SPEC,
    first_per(
        DEDUPE_SOURCE,
        "l_suppkey",
        "shipped DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC, price DESC",
    ),
)
def _(spark, d):
    return dedupe.keep_last(order_lines(spark, d), ["l_suppkey"], ["shipped"])


# ---- joins ------------------------------------------------------------------

WINDOWED = "SELECT * FROM calendar WHERE commerce_year BETWEEN 1996 AND 1999"
JOINED_SPEC = "date_key:i store_key:i net_sales:d commerce_period:s commerce_week:i"


def some_years(spark, d) -> DataFrame:
    return r.calendar(spark, d).where("commerce_year between 1996 and 1999")


@query(
    "join_calendar_inner",
    JOINED_SPEC,
    f"SELECT * FROM store_day JOIN ({WINDOWED}) USING (date_key)",
)
def _(spark, d):
    days = rollups.store_day(r.sales_lines(spark, d))
    cal = some_years(spark, d)
    return joins.join_calendar(days, cal, ["commerce_period", "commerce_week"])


@query(
    "join_calendar_left",
    JOINED_SPEC,
    f"SELECT * FROM store_day LEFT JOIN ({WINDOWED}) USING (date_key)",
)
def _(spark, d):
    days = rollups.store_day(r.sales_lines(spark, d))
    cal = some_years(spark, d)
    return joins.join_calendar(days, cal, ["commerce_period", "commerce_week"], how="left")


@query(
    "join_store_inner",
    "date_key:i store_key:i net_sales:d chain_format:s open_m2:i",
    "SELECT * FROM store_day JOIN (SELECT * FROM stores WHERE status IS NOT NULL) USING (store_key)",
)
def _(spark, d):
    days = rollups.store_day(r.sales_lines(spark, d))
    known = r.stores(spark, d).where("status is not null")
    return joins.join_dimension(days, known, "store_key", ["chain_format", "open_m2"])


@query(
    "join_kpi_left",
    "date_key:i store_key:i net_sales:d ticket_count:i traffic_estimate:i",
    """SELECT store_day.date_key, store_day.store_key, store_day.net_sales, ticket_count,
       traffic_estimate
       FROM store_day LEFT JOIN sold USING (date_key, store_key)""",
)
def _(spark, d):
    days = rollups.store_day(r.sales_lines(spark, d))
    keys = ["date_key", "store_key"]
    kpi = r.sold_tickets(spark, d)
    return joins.join_dimension(days, kpi, keys, ["ticket_count", "traffic_estimate"], "left")


YEAR_AGO_SPEC = "date_key:i store_key:i net_sales:d net_sales_sss:d unit_qty_sss:i"
YEAR_AGO_SQL = """SELECT c.date_key, c.store_key, c.net_sales, l.net_sales AS net_sales_sss,
    l.unit_qty AS unit_qty_sss FROM store_day c LEFT JOIN store_day l
    ON l.store_key = c.store_key AND l.date_value = c.date_value - 364"""
YEAR_AGO_VALUES = {"net_sales": "net_sales_sss", "unit_qty": "unit_qty_sss"}


def dated_store_days(spark, d) -> DataFrame:
    days = rollups.totals(
        r.sales_lines(spark, d), ["date_key", "store_key"], ["net_sales", "unit_qty"]
    )
    return days.withColumn("date_value", day_of_key("date_key"))


@query("year_ago_self_join", YEAR_AGO_SPEC, YEAR_AGO_SQL)
def _(spark, d):
    keyed = joins.with_comparison_keys(dated_store_days(spark, d), "date_value")
    return joins.year_ago_by_join(keyed, "store_key", "date_key", "date_key_sss", YEAR_AGO_VALUES)


@query("year_ago_range_frame", YEAR_AGO_SPEC, YEAR_AGO_SQL)
def _(spark, d):
    return joins.year_ago_by_window(
        dated_store_days(spark, d), "store_key", "date_value", YEAR_AGO_VALUES
    )


@query(
    "month_close_lookup",
    "date_key:i store_key:i net_sales:d net_sales_mc:d mc_variation_pct:d",
    f"""SELECT c.date_key, c.store_key, c.net_sales, l.net_sales AS net_sales_mc,
        {half_up("c.net_sales - l.net_sales", "l.net_sales", 6)} AS mc_variation_pct
        FROM store_day c LEFT JOIN store_day l ON l.store_key = c.store_key
        AND l.date_value = (c.date_value - INTERVAL 1 YEAR)::DATE""",
)
def _(spark, d):
    return joins.month_close_by_window(
        dated_store_days(spark, d), "store_key", "date_key", {"net_sales": "net_sales_mc"}
    ).withColumn("mc_variation_pct", m.variation_pct("net_sales", "net_sales_mc"))


@query("null_safe_merge_state", UPSERT_COLUMNS, UPSERT_SQL)
def _(spark, d):
    stored, batch = upsert_sides(spark, d)
    return merged(stored, batch, ["o_orderkey", "part_key"])


# ---- rollups, windows, calendar ---------------------------------------------


@query("till_lines_to_daily_sales", SALES_SPEC, "SELECT * FROM sales")
def _(spark, d):
    return r.daily_sales(spark, d)


@query(
    "till_lines_to_store_kpi",
    "date_key:i store_key:i ticket_count:i transaction_count:i avg_basket:d traffic_estimate:i "
    "sales_m2:d gross_sales:d net_sales:d",
    "SELECT * FROM kpi",
)
def _(spark, d):
    return r.store_kpi(spark, d)


@query(
    "period_actuals",
    "commerce_period:s store_key:i actual_sales:d",
    "SELECT commerce_period, store_key, sum(net_sales) AS actual_sales FROM base GROUP BY ALL",
)
def _(spark, d):
    dated = attach_calendar(dated_store_days(spark, d), "date_value", ("commerce_period",))
    return rollups.period_actuals(dated)


@query(
    "period_starts",
    "commerce_period:s calendar_month_start:s",
    """SELECT commerce_period, min(date_value) AS calendar_month_start FROM calendar
       GROUP BY commerce_period""",
)
def _(spark, d):
    return rollups.period_starts(r.calendar(spark, d))


@query(
    "grand_totals",
    "label:s value:d",
    """SELECT 'sales' AS label, sum(net_amount) AS value FROM lines
       UNION ALL SELECT 'orders', sum(o_totalprice::DECIMAL(18,4)) FROM orders
       UNION ALL SELECT 'nothing', 0""",
)
def _(spark, d):
    net = bal.total(r.lines(spark, d), "sales", "net_amount")
    priced = cast_money(orders(spark, d), ["o_totalprice"])
    taken = bal.total(priced, "orders", "o_totalprice")
    none = bal.total(priced.where("o_orderstatus = 'X'"), "nothing", "o_totalprice")
    return net.unionByName(taken).unionByName(none)


@query(
    "rows_per_table",
    "table_name:s rows:i",
    """SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem
       UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'supplier', count(*) FROM supplier
       UNION ALL SELECT 'part', count(*) FROM part""",
)
def _(spark, d):
    names = ("lineitem", "orders", "supplier", "part")
    return rollups.row_counts({n: r.table(spark, d, n) for n in names})


@query(
    "running_month_and_year",
    "date_key:i store_key:i net_sales:d mtd_sales:d ytd_sales:d",
    """SELECT date_key, store_key, net_sales,
       sum(net_sales) OVER (PARTITION BY store_key, commerce_year, commerce_month
           ORDER BY date_key ROWS UNBOUNDED PRECEDING) AS mtd_sales,
       sum(net_sales) OVER (PARTITION BY store_key, commerce_year
           ORDER BY date_key ROWS UNBOUNDED PRECEDING) AS ytd_sales FROM base""",
)
def _(spark, d):
    dated = attach_calendar(
        dated_store_days(spark, d), "date_value", ("commerce_year", "commerce_month")
    )
    return running.with_running_totals(
        dated, "net_sales", "store_key", "commerce_year", "commerce_month", "date_key"
    )


@query(
    "inventory_ledger",
    INVENTORY_SPEC,
    "SELECT * FROM inventory",
)
def _(spark, d):
    return r.inventory(spark, d)


@query(
    "line_pricing",
    "txn_id:s line_id:i product_key:i unit_qty:i gross:d discount:d net:d tax:d cost:d promo:b",
    """SELECT *, round(net::DOUBLE * 0.19 / 1.19, 2) AS tax, discount > 0 AS promo FROM (
        SELECT *, gross - discount AS net FROM (
            SELECT *, round(gross * rate, 2) AS discount FROM (
                SELECT l_orderkey AS txn_id, l_linenumber AS line_id, product_key, unit_qty,
                    l_discount::DECIMAL(4,2) AS rate, round(unit_cost * unit_qty, 2) AS cost,
                    CASE WHEN uom = 'KG' THEN round(retail_price * barcode_weight_kg, 2)
                        ELSE round(retail_price * unit_qty, 2) END AS gross
                FROM (SELECT l.*, p.*, CASE WHEN uom = 'KG' THEN 1 ELSE l_quantity::INT END
                    AS unit_qty FROM lineitem l JOIN products p ON l_partkey = product_key)
            )
        )
    )""",
)
def _(spark, d):
    items = r.lineitem(spark, d).selectExpr(
        "cast(l_orderkey as string) txn_id", "l_linenumber line_id", "l_partkey product_key",
        "cast(l_quantity as int) counted", "cast(l_discount as decimal(4,2)) rate",
    )
    priced = joins.join_dimension(
        items, r.products(spark, d), "product_key",
        ["retail_price", "unit_cost", "uom", "barcode_weight_kg"],
    )
    priced = priced.withColumn("unit_qty", F.when(F.col("uom") == "KG", 1).otherwise(F.col("counted")))
    gross = m.line_gross("retail_price", "unit_qty", "uom", "barcode_weight_kg")
    priced = priced.withColumn("gross", gross)
    priced = priced.withColumn("discount", m.line_discount("gross", "rate"))
    priced = priced.withColumn("net", F.col("gross") - F.col("discount"))
    return priced.withColumns(
        {
            "tax": m.contained_tax("net"),
            "cost": m.line_cost("unit_cost", "unit_qty"),
            "promo": F.col("discount") > 0,
        }
    )


@query("commerce_calendar", CALENDAR_SPEC, "SELECT * FROM calendar")
def _(spark, d):
    return r.calendar(spark, d)


@query(
    "calendar_on_orders",
    CALENDAR_SPEC.replace("date_value:s", "o_orderdate:s") + " o_orderkey:i",
    "SELECT *, strftime(o_orderdate, '%Y%m%d')::BIGINT AS date_key FROM ("
    + calendar_of(f"({ORDERS_SQL})", "o_orderdate")
    + ")",
)
def _(spark, d):
    return attach_calendar(orders(spark, d), "o_orderdate")


# ---- facts ------------------------------------------------------------------

FACT_SALES_SPEC = SALES_SPEC + " margin_amount:d margin_pct:d"


@query("fact_sales", FACT_SALES_SPEC, "SELECT * FROM fact_sales")
def _(spark, d):
    return star.fact_sales(r.daily_sales(spark, d))


STORE_DAY_SPEC = (
    "date_key:i date_value:s commerce_year:i commerce_quarter:i commerce_month:i "
    "commerce_period:s date_key_sss:i date_key_mc:i store_key:i chain_format:s open_m2:i "
    "unit_qty:i gross_sales:d net_sales:d discount_amount:d tax_amount:d cost_amount:d "
    "promo_line_count:i ticket_count:i transaction_count:i traffic_estimate:i mtd_sales:d "
    "ytd_sales:d discount_rate:d avg_basket:d sales_m2:d net_sales_sss:d unit_qty_sss:i "
    "ticket_count_sss:i sss_variation_pct:d"
)


def store_day_fact(spark, d, **options) -> DataFrame:
    return star.fact_store_day(
        r.sales_lines(spark, d), r.stores(spark, d), r.sold_tickets(spark, d), **options
    )


@query("fact_store_day", STORE_DAY_SPEC, "SELECT * FROM fact_store_day")
def _(spark, d):
    return store_day_fact(spark, d)


@query("fact_store_day_by_self_join", STORE_DAY_SPEC, "SELECT * FROM fact_store_day")
def _(spark, d):
    return store_day_fact(spark, d, calendar=r.calendar(spark, d), self_join=True)


@query(
    "fact_store_day_with_month_close",
    STORE_DAY_SPEC + " net_sales_mc:d mc_variation_pct:d",
    "SELECT * FROM fact_store_day",
)
def _(spark, d):
    return store_day_fact(spark, d, month_close=True)


@query(
    "fact_store_day_as_of",
    STORE_DAY_SPEC,
    "SELECT * FROM fact_store_day WHERE date_key <= 19990630",
)
def _(spark, d):
    return store_day_fact(spark, d, as_of="1999-06-30")


@query(
    "fact_inventory",
    INVENTORY_SPEC + " days_on_hand:d sell_through_pct:d stock_value:d",
    "SELECT * FROM fact_inventory",
)
def _(spark, d):
    return star.fact_inventory(r.inventory(spark, d))


BUDGET_FACT_SPEC = BUDGET_SPEC + " actual_sales:d budget_usage_pct:d budget_gap:d"


def budget_fact(spark, d) -> DataFrame:
    days = attach_calendar(dated_store_days(spark, d), "date_value", ("commerce_period",))
    return star.fact_budget(r.budget(spark, d), days)


@query("fact_budget", BUDGET_FACT_SPEC, "SELECT * FROM fact_budget")
def _(spark, d):
    return budget_fact(spark, d)


@query(
    "fact_budget_by_dept",
    BUDGET_FACT_SPEC,
    f"""SELECT b.*, actual_sales,
        {half_up("actual_sales", "budget_amount", 6)} AS budget_usage_pct,
        actual_sales - budget_amount AS budget_gap
        FROM budget b LEFT JOIN (
            SELECT commerce_period, store_key, dept, sum(net_sales) AS actual_sales
            FROM sales JOIN calendar USING (date_key) JOIN products USING (product_key)
            GROUP BY ALL
        ) USING (commerce_period, store_key, dept)""",
)
def _(spark, d):
    return star.fact_budget_by_dept(
        r.budget(spark, d), r.sales_lines(spark, d), r.products(spark, d)
    )


# ---- dashboards -------------------------------------------------------------


@query(
    "dashboard_company_day",
    "date_key:i net_sales:d gross_sales:d discount_amount:d unit_qty:i tax_amount:d "
    "cost_amount:d margin_amount:d stores_active:i",
    """SELECT date_key, sum(net_sales) AS net_sales, sum(gross_sales) AS gross_sales,
       sum(discount_amount) AS discount_amount, sum(unit_qty) AS unit_qty,
       sum(tax_amount) AS tax_amount, round(sum(cost_amount), 2) AS cost_amount,
       round(sum(net_sales - cost_amount), 2) AS margin_amount,
       count(DISTINCT store_key) AS stores_active
       FROM store_day GROUP BY date_key ORDER BY date_key DESC LIMIT 60""",
)
def _(spark, d):
    return dashboards.company_day(spark, rollups.store_day(r.sales_lines(spark, d)))


@query(
    "dashboard_store_listing",
    "store_key:i store_name:s date_key:i net_sales:d net_sales_sss:d sss_variation_pct:d "
    "mtd_sales:d ytd_sales:d avg_basket:d sales_m2:d",
    """SELECT f.*, s.name AS store_name FROM fact_store_day f JOIN stores s USING (store_key)
       WHERE commerce_period = '1999-03'""",
)
def _(spark, d):
    return dashboards.store_listing(
        spark, store_day_fact(spark, d), r.stores(spark, d), "1999-03"
    )


@query(
    "dashboard_category_day",
    "date_key:i category:s dept:s qty:i net_sales:d margin:d",
    """SELECT date_key, category, dept, sum(unit_qty) AS qty, sum(net_sales) AS net_sales,
       sum(margin_amount) AS margin FROM fact_sales JOIN products USING (product_key)
       GROUP BY ALL""",
)
def _(spark, d):
    margin = m.margin_amount("net_sales", "cost_amount")
    sales = r.sales_lines(spark, d).withColumn("margin_amount", margin)
    return dashboards.category_day(spark, sales, r.products(spark, d))


@query(
    "dashboard_stock_state",
    "date_key:i store_key:i stock_state:s products:i units_on_hand:i stock_value:d "
    "avg_days_on_hand:d",
    """SELECT date_key, store_key, stock_state, count(*) AS products,
       sum(on_hand_qty) AS units_on_hand, sum(stock_value) AS stock_value,
       round(sum(days_on_hand::DECIMAL(18,2)) / count(days_on_hand), 1) AS avg_days_on_hand
       FROM fact_inventory WHERE date_key = (SELECT max(date_key) FROM lines) GROUP BY ALL""",
)
def _(spark, d):
    return dashboards.stock_state(spark, star.fact_inventory(r.inventory(spark, d)))


@query(
    "dashboard_budget_status",
    "commerce_period:s store_key:i dept:s budget:d actual:d gap:d usage_pct:d",
    """SELECT commerce_period, store_key, dept, round(sum(budget_amount), 0) AS budget,
       round(sum(actual_sales), 0) AS actual, round(sum(budget_gap), 0) AS gap,
       round(sum(budget_usage_pct::DECIMAL(26,6)) * 100, 1) AS usage_pct
       FROM fact_budget GROUP BY ALL""",
)
def _(spark, d):
    return dashboards.budget_status(spark, budget_fact(spark, d))


@query(
    "dashboard_comparable_week",
    "commerce_period:s commerce_week:i net_sales:d net_sales_sss:d sss_var_pct:d",
    f"""SELECT commerce_period, commerce_week, round(now, 2) AS net_sales,
        round(before, 2) AS net_sales_sss,
        {half_up("(now - before) * 100", "before", 2)} AS sss_var_pct
        FROM (SELECT commerce_period, commerce_week, sum(net_sales) AS now,
            sum(net_sales_sss) AS before FROM fact_store_day GROUP BY ALL)""",
)
def _(spark, d):
    days = joins.year_ago_by_window(
        dated_store_days(spark, d), "store_key", "date_value", YEAR_AGO_VALUES
    )
    return dashboards.comparable_week(spark, days, r.calendar(spark, d))


@query(
    "dashboard_store_traffic",
    "store_key:i commerce_period:s tickets:i transactions:i avg_basket:d traffic:d",
    f"""SELECT store_key, commerce_period, tickets, transactions,
        {half_up("net", "tickets", 2)} AS avg_basket, round(traffic, 0) AS traffic
        FROM (SELECT store_key, commerce_period, sum(ticket_count) AS tickets,
            sum(transaction_count) AS transactions, sum(net_sales) AS net,
            sum(traffic_estimate) AS traffic FROM base GROUP BY ALL)""",
)
def _(spark, d):
    base = star.store_day_base(
        r.sales_lines(spark, d), r.stores(spark, d), r.sold_tickets(spark, d)
    )
    return dashboards.store_traffic(spark, base)


# ---- quality ----------------------------------------------------------------

CHECK_SPEC = "table_name:s expectation_type:s column:s passed:b observed:s detail:s"


def _sql_not_null(col: str) -> str:
    n = f"count(*) FILTER (WHERE {col} IS NULL)"
    return f"""'expect_column_values_to_not_be_null', '{col}', {n} = 0,
        {n} || '/' || count(*) || ' nulls',
        '{{"null_count":' || {n} || ',"row_count":' || count(*) || '}}'"""


def _sql_rows() -> str:
    return """'expect_row_count_to_be_between', '', count(*) >= 1, count(*) || ' rows',
        '{"min_value":1,"observed":' || count(*) || '}'"""


def _sql_low(col: str, low: str) -> str:
    shown = f"""'{{"min_value":{low},"observed_min":' || min({col})::DOUBLE || '}}'"""
    return f"""'expect_column_values_to_be_between', '{col}', coalesce(min({col}) >= {low}, true),
        {shown}, {shown}"""


def _sql_both(col: str, low: str, high: str) -> str:
    shown = f"""'{{"max_value":{high},"observed_max":' || max({col})::DOUBLE ||
        ',"min_value":{low},"observed_min":' || min({col})::DOUBLE || '}}'"""
    return f"""'expect_column_values_to_be_between', '{col}',
        min({col}) >= {low} AND max({col}) <= {high}, {shown}, {shown}"""


def _sql_contains(col: str, values: tuple[str, ...]) -> str:
    want = "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"
    have = f"list_sort(list_intersect({want}, list(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL)))"
    miss = f"list_filter({want}, lambda v: NOT list_contains({have}, v))"
    return f"""'expect_column_distinct_values_to_contain_set', '{col}', len({miss}) = 0,
        'missing=[' || array_to_string(list_transform({miss}, lambda v: '''' || v || ''''), ', ')
            || ']',
        '{{"expected":' || to_json({want}) || ',"observed":' || to_json({have}) || '}}'"""


def _sql_suite(label: str, source: str, checks: list[str]) -> str:
    names = "expectation_type, column_, passed, observed, detail"
    one = [
        f"SELECT * FROM (SELECT {c} FROM {source}) t_({names})" for c in checks
    ]
    both = " UNION ALL ".join(one)
    return f"""SELECT '{label}' AS table_name, * FROM ({both}) UNION ALL
        SELECT '{label}', 'overall', '', count(*) FILTER (WHERE NOT passed) <= 0.05 * {len(checks)},
            count(*) FILTER (WHERE NOT passed) || '/{len(checks)} failed', '{{"threshold":0.05}}'
        FROM ({both})"""


SEEN_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SUITES_SQL = " UNION ALL ".join(
    [
        _sql_suite("sil_store", "stores", [
            _sql_not_null("store_key"), _sql_rows(),
            _sql_contains("chain_format", entities.CHAIN_FORMATS)]),
        _sql_suite("sil_product", "products", [
            _sql_not_null("product_key"), _sql_not_null("sku"),
            _sql_contains("category", entities.CATEGORIES), _sql_rows()]),
        _sql_suite("sil_calendar_445", "calendar", [
            _sql_not_null("date_key"), _sql_both("commerce_month", "1.0", "12.0"),
            _sql_both("commerce_quarter", "1.0", "4.0"),
            _sql_both("commerce_week", "1.0", "53.0")]),
        _sql_suite("sil_daily_sales", "sales", [
            _sql_not_null("date_key"), _sql_not_null("store_key"), _sql_not_null("product_key"),
            _sql_low("net_sales", "0.0"), _sql_rows()]),
        _sql_suite("sil_pos_line", "lines", [
            _sql_not_null("txn_id"), _sql_not_null("txn_date"),
            _sql_low("net_amount", "0.0"), _sql_rows()]),
        _sql_suite("sil_store_daily_kpi", "kpi", [
            _sql_not_null("date_key"), _sql_not_null("store_key"),
            _sql_low("net_sales", "0.0"), _sql_rows()]),
        _sql_suite("sil_daily_inventory", "inventory", [
            _sql_not_null("store_key"), _sql_not_null("product_key"),
            _sql_low("on_hand_qty", "0.0"),
            _sql_contains("stock_state", m.STOCK_STATES), _sql_rows()]),
        _sql_suite("sil_budget", "budget", [
            _sql_not_null("commerce_period"), _sql_not_null("store_key"),
            _sql_low("budget_amount", "0.0"), _sql_rows()]),
    ]
)
ROLE_OF = {
    "sil_store": r.stores,
    "sil_product": r.products,
    "sil_calendar_445": r.calendar,
    "sil_daily_sales": r.daily_sales,
    "sil_pos_line": r.lines,
    "sil_store_daily_kpi": r.store_kpi,
    "sil_daily_inventory": r.inventory,
    "sil_budget": r.budget,
}


def suite_results(spark, d) -> DataFrame:
    out = None
    for entity in entities.ENTITIES:
        found = entity.checked(ROLE_OF[entity.table](spark, d))
        found = found.withColumn("table_name", F.lit(entity.table))
        out = found if out is None else out.unionByName(found)
    return out


@query("quality_suites", CHECK_SPEC, f"SELECT *, column_ AS \"column\" FROM ({SUITES_SQL})")
def _(spark, d):
    return suite_results(spark, d)


@query(
    "quality_further_checks",
    "expectation_type:s column:s passed:b observed:s",
    """SELECT t.* FROM (SELECT
            sum(o_totalprice::DECIMAL(18,4)) AS s, min(length(o_orderpriority)) AS lo,
            max(length(o_orderpriority)) AS hi, count(DISTINCT o_custkey) AS u, count(*) AS n
        FROM orders) a, LATERAL (VALUES
        ('expect_column_sum_to_be_between', 'o_totalprice', s BETWEEN 1 AND 1e15,
            'sum=' || format('{:,.2f}', s::DOUBLE)),
        ('expect_column_value_lengths_to_be_between', 'o_orderpriority', lo >= 1 AND hi <= 10,
            '{"max_value":10,"observed_max":' || hi || ',"min_value":1,"observed_min":' || lo || '}'),
        ('expect_column_unique_value_count_to_be_between', 'o_custkey', u >= 2,
            u || ' unique values'),
        ('expect_row_count_to_be_between', '', n BETWEEN 1 AND 10, n || ' rows'),
        ('overall', '', false, '2/4 failed')) t(expectation_type, "column", passed, observed)""",
)
def _(spark, d):
    checks = [
        quality.sum_between("o_totalprice", 1.0, 1e15),
        quality.lengths_between("o_orderpriority", 1, 10),
        quality.unique_count_between("o_custkey", 2),
        quality.row_count(1, 10),
    ]
    return quality.evaluate(cast_money(orders(spark, d), ["o_totalprice"]), checks)


@query(
    "rows_kept_and_dropped",
    "kept:i dropped:i",
    """SELECT count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_totalprice >= 100000) AS kept,
       count(*) FILTER (WHERE o_orderstatus = 'P' OR o_totalprice < 100000) AS dropped
       FROM orders""",
)
def _(spark, d):
    # An unknown price is no valid price.
    valid = F.expr("nullif(o_orderstatus, 'P') is not null and o_totalprice >= 100000")
    return quality.count_dropped(orders(spark, d), valid)


@query(
    "declared_gated_sales",
    "date_key:i store_key:i product_key:i unit_qty:i gross_sales:d net_sales:d tax_amount:d "
    "cost_amount:d margin_amount:d",
    """SELECT *, net_sales - cost_amount AS margin_amount FROM sales
       WHERE promo_line_count = 0""",
)
def _(spark, d):
    # Rows with promotion lines get a key that is no number.
    keyless = F.expr("case when promo_line_count = '0' then store_key else 'none' end")
    text = as_text(r.daily_sales(spark, d)).withColumn("store_key", keyless)
    return declared.gated_sales(text)


@query(
    "declared_store_day",
    "date_key:i store_key:i net_sales:d unit_qty:i commerce_period:s commerce_year:i "
    "date_key_sss:i mtd_sales:d ytd_sales:d",
    f"""SELECT *, sum(net_sales) OVER (PARTITION BY store_key, commerce_period ORDER BY date_key
            ROWS UNBOUNDED PRECEDING) AS mtd_sales,
        sum(net_sales) OVER (PARTITION BY store_key, commerce_year ORDER BY date_key
            ROWS UNBOUNDED PRECEDING) AS ytd_sales
        FROM store_day LEFT JOIN ({WINDOWED}) USING (date_key)""",
)
def _(spark, d):
    return declared.store_day(r.sales_lines(spark, d), some_years(spark, d))


BALANCE_SPEC = "name:s expected:d actual:d diff_pct:d passed:b"
BALANCES_SQL = """
    SELECT name, expected, actual,
        round(abs(expected - actual) / greatest(abs(expected), 1e-9) * 100, 4) AS diff_pct,
        abs(expected - actual) / greatest(abs(expected), 1e-9) <= 0.001 AS passed
    FROM (
        SELECT 'silver vs gold fact_sales (net)' AS name,
            (SELECT sum(net_sales)::DOUBLE FROM sales) AS expected,
            (SELECT sum(net_sales)::DOUBLE FROM sales) AS actual
        UNION ALL SELECT 'fact_sales vs store_daily (net)',
            (SELECT sum(net_sales)::DOUBLE FROM sales),
            (SELECT sum(net_sales)::DOUBLE FROM base)
        UNION ALL SELECT 'silver kpi vs store_daily (net)',
            (SELECT sum(net_sales)::DOUBLE FROM kpi),
            (SELECT sum(net_sales)::DOUBLE FROM base)
    )
    UNION ALL SELECT 'budget sanity (amount>0)', 0, 0, 0,
        (SELECT coalesce(sum(budget_amount), 0) >= 0 FROM budget)"""


@query("layer_balances", BALANCE_SPEC, BALANCES_SQL)
def _(spark, d):
    daily = r.daily_sales(spark, d)
    kpi = r.store_tickets(spark, d)
    base = star.store_day_base(r.sales_lines(spark, d), r.stores(spark, d), kpi)
    return star.layer_balances(daily, star.fact_sales(daily), base, kpi, r.budget(spark, d))


@query(
    "sales_lost_by_joins",
    "before:d after:d lost:d",
    """SELECT before::DOUBLE AS before, after::DOUBLE AS after,
       before::DOUBLE - after::DOUBLE AS lost FROM (
        SELECT (SELECT sum(net_sales) FROM store_day) AS before,
        (SELECT sum(net_sales) FROM store_day JOIN stores USING (store_key)
            WHERE status IS NOT NULL) AS after)""",
)
def _(spark, d):
    days = rollups.store_day(r.sales_lines(spark, d))
    known = r.stores(spark, d).where("status is not null")
    return star.dropped_by_joins(days, joins.join_dimension(days, known, "store_key", []))


@query(
    "quality_report_lines",
    "line:s",
    """SELECT '| ' || expectation_type || ':' || column_ || ' | '
       || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || ' | ' || observed || ' |' AS line
       FROM (""" + _sql_suite("orders", "orders", [
           _sql_not_null("o_orderkey"), _sql_rows(),
           _sql_contains("o_orderstatus", ("F", "O", "X"))]) + ")",
)
def _(spark, d):
    checks = [
        quality.not_null("o_orderkey"),
        quality.row_count(1),
        quality.contains("o_orderstatus", ["F", "O", "X"]),
    ]
    results = quality.evaluate(orders(spark, d), checks)
    _, written = sinks.write_report(results, fresh_dir(spark, "report"), "Orders")
    text = spark.read.text(written)
    return text.where("value rlike ':.*(PASS|FAIL)'").withColumnRenamed("value", "line")


# ---- layers and streams -----------------------------------------------------

FEED_ROLES = {
    "stores_master": r.stores,
    "products_master": r.products,
    "calendar_445": r.calendar,
    "sales_daily_store_sku": r.dealt_daily_sales,
    "pos_line_items": lambda s, d: r.lines(s, d).selectExpr(
        "* except (is_promo, return_flag)",
        "case when return_flag = 'A' then 'card' else 'cash' end payment_type",
        "'pos' channel",
        "cast(is_promo as string) is_promo",
    ),
    "store_daily_kpi": r.store_kpi,
    "daily_inventory": r.inventory,
    "budget": r.budget,
}


def landed_feeds(spark, d) -> tuple[str, tuple[feeds.Feed, ...]]:
    """All feeds as gzip CSV in the shared folder; returns root and feed list.

    The writer makes a folder of part files also for snapshot feeds.
    """
    root = fresh_dir(spark, "feeds")
    for feed in feeds.FEEDS:
        deliver(spark, d, root, feed)
    return root, feeds.FEEDS


def deliver(spark, d, root: str, feed: feeds.Feed) -> None:
    columns = [f.name for f in spark.createDataFrame([], feed.schema).schema]
    with shuffles_dropped(spark):
        write_csv(FEED_ROLES[feed.table](spark, d).select(*columns), f"{root}/{feed.path}")


def load_layers(spark, d, label: str) -> layers.Layers:
    """Each feed is delivered and loaded before the next one, and its files go once they are loaded,
    so that they do not all lie on disk beside the tables."""
    root = fresh_dir(spark, "feeds")
    names = layers.Layers(*[own_schema(spark, f"{label}-{x}") for x in ("raw", "ref", "star")])
    for feed in feeds.FEEDS:
        deliver(spark, d, root, feed)
        raw.load_all(spark, root, names.landing, (feed,))
        if feed is feeds.FEEDS[3]:
            # A daily feed delivered twice leaves copies that refining removes.
            raw.load_feed(spark, root, feed, names.landing)
        remove(spark, f"{root}/{feed.path}")
    return names


FEED_ROWS = {
    "brz_stores_master": "stores",
    "brz_products_master": "products",
    "brz_calendar_445": "calendar",
    "brz_pos_line_items": "lines",
    "brz_store_daily_kpi": "kpi",
    "brz_daily_inventory": "inventory",
    "brz_budget": "budget",
}


@query(
    "feeds_landed",
    "table_name:s rows:i",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {b}" for t, b in FEED_ROWS.items()
    )
    + " UNION ALL SELECT 'brz_sales_daily_store_sku', 2 * count(*) FROM sales",
)
def _(spark, d):
    names = load_layers(spark, d, "landed")
    listed = {f"brz_{f.table}": spark.table(f"{names.landing}.brz_{f.table}") for f in feeds.FEEDS}
    return rollups.row_counts(listed)


LAYER_ROWS = {
    "dim_store": "stores",
    "dim_product": "products",
    "dim_calendar_445": "calendar",
    "fact_sales": "sales",
    "fact_sales_store_daily": "base",
    "fact_inventory": "inventory",
    "fact_budget": "budget",
}


# A row for each check of the eight suites, and one for each suite's verdict.
SUITE_ROWS = sum(len(e.checks) + 1 for e in entities.ENTITIES)


@query(
    "layers_end_to_end",
    "name:s value:d",
    " UNION ALL ".join(
        f"SELECT 'rows {t}' AS name, count(*) AS value FROM {b}" for t, b in LAYER_ROWS.items()
    )
    + f""" UNION ALL SELECT 'net', sum(net_sales) FROM base
        UNION ALL SELECT 'checks', {SUITE_ROWS} + (SELECT count(*) FROM ({BALANCES_SQL}))
        UNION ALL SELECT 'failed', (SELECT count(*) FROM ({BALANCES_SQL}) WHERE NOT passed)
            + (SELECT CASE WHEN count(DISTINCT category) < {len(entities.CATEGORIES)} THEN 2 ELSE 0
               END FROM products WHERE category IN {entities.CATEGORIES})""",
)
def _(spark, d):
    names = load_layers(spark, d, "run")
    checks = layers.refine(spark, names)
    tables = layers.build_star(spark, names)
    # The category list does not fit these parts: a check and its suite's verdict fail.
    verdict = layers.gate(checks, layers.balance_layers(spark, names), stop=False)
    counts = rollups.row_counts({t.split(".")[1]: spark.table(t) for t in tables})
    rows = counts.select(
        F.concat(F.lit("rows "), "table_name").alias("name"), F.col("rows").cast("double").alias("value")
    )
    net = bal.total(spark.table(f"{names.star}.fact_sales_store_daily"), "net", "net_sales")
    tally = verdict.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                    for c in ("checks", "failed")
                ]
            )
        )
    )
    return rows.unionByName(net.withColumnRenamed("label", "name")).unionByName(tally)


EVENT_SCHEMA = "event_id bigint, day date, user_id bigint, event_type string, value double"


@query(
    "stream_file_intake",
    EVENT_COLUMNS + " load:s",
    f"SELECT *, 'stream:events' AS load FROM ({EVENTS_SQL})",
)
def _(spark, d):
    source, checkpoint = fresh_dir(spark, "stream-in"), fresh_dir(spark, "stream-state")
    target = f"{own_schema(spark, 'stream')}.events"
    events = r.event_days(spark, d)
    # Two deliveries, and a third start that finds nothing new.
    for part in ("day < '2024-01-16'", "day >= '2024-01-16'", None):
        if part:
            events.where(part).write.mode("append").option("header", "true").csv(source)
        stream = intake.file_stream(spark, source, EVENT_SCHEMA, "events")
        intake.drain_to_table(stream, target, checkpoint)
    return spark.table(target).withColumnRenamed("_load_id", "load")


@query(
    "stream_upsert",
    EVENT_COLUMNS,
    """SELECT event_id, ts::DATE AS day, user_id, event_type,
       CASE WHEN ts::DATE >= '2024-01-16' THEN value + 1 ELSE value END AS value FROM events""",
)
def _(spark, d):
    source, checkpoint = fresh_dir(spark, "stream-in"), fresh_dir(spark, "stream-state")
    target = f"{own_schema(spark, 'stream')}.events"
    events = r.event_days(spark, d)
    corrected = events.where("day >= '2024-01-16'").withColumn("value", F.col("value") + 1)
    # Both deliveries are there before the first drain; the file that came last wins.
    for delivery in (events, corrected):
        delivery.write.mode("append").option("header", "true").csv(source)
    for _ in range(2):
        stream = intake.file_stream(spark, source, EVENT_SCHEMA, "events")
        intake.drain_to_upsert(stream, target, ["event_id"], checkpoint)
    return spark.table(target)


@query(
    "declared_chain_from_stream",
    "date_key:i store_key:i net_sales:d unit_qty:i commerce_period:s mtd_sales:d ytd_sales:d",
    """SELECT *, sum(net_sales) OVER (PARTITION BY store_key, commerce_period ORDER BY date_key
            ROWS UNBOUNDED PRECEDING) AS mtd_sales,
       sum(net_sales) OVER (PARTITION BY store_key, commerce_year ORDER BY date_key
            ROWS UNBOUNDED PRECEDING) AS ytd_sales
       FROM base""",
)
def _(spark, d):
    name = own_schema(spark, "declared")
    sinks.append_rows(r.daily_sales(spark, d), f"{name}.raw_sales")
    stream = intake.table_stream(spark, f"{name}.raw_sales", "declared")
    landed = f"{name}.brz_sales"
    intake.drain_to_table(stream, landed, fresh_dir(spark, "stream-state"))
    sales = f"{name}.sil_daily_sales"
    sinks.replace_table(declared.gated_sales(spark.table(landed)), sales)
    return declared.store_day(spark.table(sales), r.calendar(spark, d))


from . import maintained  # noqa: E402, F401  registers its queries here

__all__ = ["QUERIES", "SQL"]
