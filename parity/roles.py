"""The given tables in retail roles: suppliers as stores, parts as articles, order
lines as till lines. ``raw_*`` frames carry text and defects for the cleaners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import measures as m
from tillwork.functions.retail_calendar import attach_calendar, date_key
from tillwork.operators import joins, rollups
from tillwork.operators.calendar import calendar_spanning
from tillwork.operators.running import clamped_balance


# Layouts of the given tables; named, they need no inference job.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    gross = F.col("l_extendedprice").cast(m.MONEY)
    rate = F.col("l_discount").cast("decimal(4,2)")
    discount = m.line_discount(gross, rate)
    net = (gross - discount).cast(m.MONEY)
    return lineitem(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("txn_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
        F.col("l_suppkey").alias("store_key"),
        F.col("l_partkey").alias("product_key"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("l_quantity").cast("int").alias("unit_qty"),
        gross.alias("gross_amount"),
        discount.alias("discount_amount"),
        net.alias("net_amount"),
        m.contained_tax(net).alias("tax_amount"),
        F.round(gross * F.lit("0.6").cast("decimal(2,1)"), 2).cast(m.MONEY).alias("cost_amount"),
        (rate > F.lit("0.05").cast("decimal(4,2)")).alias("is_promo"),
        F.col("l_returnflag").alias("return_flag"),
    )


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till lines with the column names of the sales fact, at line grain."""
    renamed = {k: F.col(k).alias(v) for k, v in rollups.LINE_MEASURES.items()}
    return lines(spark, sf_dir).select(
        date_key("txn_date").alias("date_key"),
        "store_key",
        "product_key",
        *renamed.values(),
        F.col("is_promo").cast("int").alias("promo_line_count"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        "cast(l_orderkey as string) txn_id",
        "cast(l_linenumber as string) line_id",
        "cast(cast(l_shipdate as date) as string) txn_date",
        "cast(l_suppkey as string) store_key",
        "cast(l_partkey as string) product_key",
        "concat('SKU-', l_partkey) sku",
        "case when l_quantity = 50 then 'fifty' else cast(cast(l_quantity as int) as string) end unit_qty",
        "cast(cast(l_extendedprice as decimal(18,2)) as string) gross_amount",
        "cast(cast(l_discount as decimal(4,2)) as string) discount_amount",
        "case when l_tax = 0 then '' else cast(cast(l_extendedprice as decimal(18,2)) as string) end net_amount",
        "cast(cast(l_tax as decimal(4,2)) as string) tax_amount",
        "'1.50' cost_amount",
        "case when l_linestatus = 'O' then ' card ' else 'Cash' end payment_type",
        "concat(' ', lower(l_returnflag)) channel",
        "case when l_discount > 0.055 then ' TRUE' when l_discount > 0.005 then 'false' end is_promo",
    )


STORE_COLUMNS = [
    "s_suppkey store_key",
    "concat('ST', s_suppkey) store_code",
    "s_name name",
    "case s_suppkey % 3 when 0 then 'hyper' when 1 then 'super' else 'express' end chain_format",
    "r_name region",
    "n_name city",
    "concat(n_name, ' ', s_suppkey) address",
    "case when s_suppkey % 17 = 5 then 0 else cast(400 + s_suppkey * 37 % 5000 as int) end open_m2",
    "date_add(date'1990-01-01', cast(s_suppkey % 1000 as int)) open_date",
    "case s_suppkey % 4 when 0 then 'Active' when 1 then 'Planned' when 2 then 'Closed' end status",
]


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    placed = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return placed.selectExpr(*STORE_COLUMNS)


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys, broken areas and dates, and a second copy of each third store."""
    once = stores(spark, sf_dir).selectExpr(
        "cast(store_key as string) store_key",
        "store_code", "name", "chain_format", "region", "city", "address",
        "case when store_key % 11 = 3 then 'n/a' else cast(open_m2 as string) end open_m2",
        "case when store_key % 13 = 4 then '1999-02-30' else cast(open_date as string) end open_date",
        "status",
    )
    copy = once.where("cast(store_key as bigint) % 3 = 0").withColumns(
        {"name": F.concat(F.lit("A "), "name"), "status": F.lit("Planned")}
    )
    return once.unionByName(copy)


PRODUCT_COLUMNS = [
    "p_partkey product_key",
    "concat('SKU-', p_partkey) sku",
    "cast(p_partkey * 7919 + 123456789 as string) ean",
    "p_name name",
    "p_brand brand",
    "p_type category",
    "case p_type when 'PROMO' then 'Perishables' when 'LARGE' then 'Nonfood' "
    "when 'ECONOMY' then 'Textile' else 'Grocery' end dept",
    "cast(p_retailprice as decimal(18,4)) retail_price",
    "cast(round(cast(p_retailprice as decimal(18,4)) * 6 / 10, 2) as decimal(18,4)) unit_cost",
    "case p_partkey % 4 when 0 then 'KG' when 1 then 'EA' when 2 then 'LT' else 'PACK' end uom",
    "case when p_partkey % 4 = 0 then cast(p_size / 10 + 0.125 as decimal(10,3)) end "
    "barcode_weight_kg",
]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*PRODUCT_COLUMNS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).selectExpr(
        "cast(product_key as string) product_key", "sku", "ean", "name", "brand", "category",
        "dept",
        "cast(retail_price as string) retail_price",
        "case when product_key % 19 = 7 then 'free' else cast(unit_cost as string) end unit_cost",
        "concat(' ', lower(uom), '  ') uom",
        "coalesce(cast(barcode_weight_kg as string), '') barcode_weight_kg",
    )


def sale_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates alone: their bounds need one column."""
    shipped = F.col("l_shipdate").cast("date").alias("txn_date")
    return table(spark, sf_dir, "lineitem").select(shipped)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_spanning(sale_days(spark, sf_dir), "txn_date")


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_sales(lines(spark, sf_dir))


def dealt_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows. These lines are almost one for each day, store and article, and a line is
    narrower than the sums it begins, so that lines move instead of sums."""
    return rollups.daily_sales(lines(spark, sf_dir).repartition("store_key", "product_key"))


def store_tickets(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    return _visited(rollups.store_day_tickets(lines(spark, sf_dir), dealt))


def sold_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets of goods that stayed sold. Store days with returns alone are absent, which is what
    joins that may find no tickets are tried on."""
    return _visited(rollups.store_day_tickets(lines(spark, sf_dir).where("return_flag <> 'R'")))


def _visited(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("traffic_estimate", F.expr("cast(ticket_count * 14 div 10 as int)"))


def store_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.store_day_kpi(store_tickets(spark, sf_dir, dealt=True), stores(spark, sf_dir))


def flows(spark: SparkSession, sf_dir: str, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Units sold, taken back and adjusted per day, store and article. Lines move once, by the
    columns ``dealt``, if later steps can use that."""
    keyed = lines(spark, sf_dir).withColumn("date_key", date_key("txn_date"))
    moved = (
        (keyed.repartition(*dealt) if dealt else keyed)
        .groupBy("date_key", "store_key", "product_key", "sku")
        .agg(
            F.expr("sum(case when return_flag <> 'R' then unit_qty end)").alias("sold_qty"),
            F.expr("sum(case when return_flag = 'R' then unit_qty else 0 end)").alias(
                "received_qty"
            ),
        )
    )
    return moved.withColumns(
        {
            "adjusted_qty": F.expr("(date_key + product_key) % 7 - 3"),
            "in_transit_qty": F.expr("(store_key + product_key) % 5"),
        }
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    opening = F.expr("(store_key * 7 + product_key * 3) % 31")
    flow = F.expr("received_qty - coalesce(sold_qty, 0) + adjusted_qty")
    # The rollup, the balance and a join with many articles all work where an article's lines are.
    moved = flows(spark, sf_dir, dealt=("product_key",))
    ledger = clamped_balance(
        moved, ["store_key", "product_key"], "date_key", flow, opening, "on_hand_qty"
    )
    priced = joins.join_dimension(
        ledger, products(spark, sf_dir), "product_key", ["unit_cost", "retail_price"]
    )
    return priced.withColumns(
        {
            "on_hand_cost": m.on_hand_cost("on_hand_qty", "unit_cost"),
            "stock_state": m.stock_state("on_hand_qty"),
        }
    )


def budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last year's sales of the same commerce month, raised by 5 % less a fixed sum."""
    dated = attach_calendar(
        lines(spark, sf_dir), "txn_date", ("commerce_year", "commerce_month")
    )
    # Dealt by article, the totals meet a large table of articles where they are.
    by_article = rollups.totals(
        dated.repartition("product_key"),
        ["commerce_year", "commerce_month", "store_key", "product_key"],
        {"net_amount": "net", "unit_qty": "qty"},
    )
    named = joins.join_dimension(by_article, products(spark, sf_dir), "product_key", ["dept"])
    last_year = rollups.totals(
        named, ["commerce_year", "commerce_month", "store_key", "dept"], ["net", "qty"]
    )
    plan = last_year.selectExpr(
        "format_string('%d-%02d', commerce_year + 1, commerce_month) commerce_period",
        "store_key",
        "dept",
        "cast(greatest(round(net * 105 / 100 - 2000, 2), 0) as decimal(18,4)) budget_amount",
        "qty budget_qty_units",
    )
    # The budget year may lie behind the last sale: describe one more year of days.
    starts = rollups.period_starts(calendar_spanning(sale_days(spark, sf_dir), "txn_date", 400))
    return joins.join_dimension(plan, starts, "commerce_period", ["calendar_month_start"], "left")


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), "user_id", "event_type", "value"
    )
