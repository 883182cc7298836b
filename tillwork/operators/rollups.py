"""Grouped totals. Every rollup is a partial aggregate before its one shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import measures as m
from ..functions.retail_calendar import date_key

# Names of the published measures.
LINE_MEASURES = {
    "unit_qty": "unit_qty",
    "gross_amount": "gross_sales",
    "net_amount": "net_sales",
    "discount_amount": "discount_amount",
    "tax_amount": "tax_amount",
    "cost_amount": "cost_amount",
}

STORE_DAY_MEASURES = (
    "unit_qty",
    "gross_sales",
    "net_sales",
    "discount_amount",
    "tax_amount",
    "cost_amount",
    "promo_line_count",
)


def narrow_sum(df: DataFrame, column: str) -> Column:
    """``sum(column)``, value and type, with two 64-bit numbers as what tasks add up and exchange.

    Spark keeps sums of decimals of more than 8 digits in wide decimals, which take twice the room
    in a task's table of groups, so that it spills sooner. Whole units and the rest behind the
    point are summed apart instead.
    Totals of 9.2e18 units, 92,000 times the largest money value, overflow, which raises.
    """
    kind = df.schema[column].dataType
    if not (isinstance(kind, DecimalType) and 8 < kind.precision <= 18 and 0 < kind.scale <= 8):
        return F.sum(column)
    whole = F.col(column).cast("bigint")
    rest = (F.col(column) - whole.cast(kind)).cast(DecimalType(kind.scale, kind.scale))
    return (F.sum(whole) + F.sum(rest)).cast(DecimalType(kind.precision + 10, kind.scale))


def totals(df: DataFrame, by: Sequence[str], sums: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Sums of columns per group; a mapping renames them."""
    named = sums if isinstance(sums, Mapping) else {c: c for c in sums}
    return df.groupBy(*by).agg(*[narrow_sum(df, c).alias(out) for c, out in named.items()])


def daily_sales(lines: DataFrame) -> DataFrame:
    """Till lines to one row per day, store and article.

    The sku belongs to the article and is grouped with it: a text ``min`` would
    turn the hash aggregate into a sort. ``ticket_count`` counts lines at this
    grain, as the daily feed does.
    """
    keyed = lines.withColumn("date_key", date_key("txn_date"))
    rolled = keyed.groupBy("date_key", "store_key", "product_key", "sku").agg(
        *[narrow_sum(lines, c).alias(out) for c, out in LINE_MEASURES.items()],
        F.count(F.lit(1)).alias("line_count"),
        F.count_if("is_promo").alias("promo_line_count"),
    )
    return rolled.withColumn("ticket_count", F.col("line_count"))


def store_day_tickets(lines: DataFrame, dealt: bool = False) -> DataFrame:
    """Till lines to tickets and sales per day and store.

    The distinct count shuffles by (day, store, ticket) first, so a store with a
    third of all lines is spread over its tickets. With ``dealt`` lines move once, by day and store,
    where both counts are taken: for tickets of few lines, of which nothing is saved by adding
    them up before the shuffle. A hot store is spread over its days.
    """
    keyed = lines.withColumn("date_key", date_key("txn_date"))
    if dealt:
        keyed = keyed.repartition("date_key", "store_key")
    rolled = keyed.groupBy("date_key", "store_key").agg(
        F.count_distinct("txn_id").alias("ticket_count"),
        narrow_sum(lines, "gross_amount").alias("gross_sales"),
        narrow_sum(lines, "net_amount").alias("net_sales"),
    )
    return rolled.withColumn("transaction_count", F.col("ticket_count"))


def store_day_kpi(tickets: DataFrame, stores: DataFrame) -> DataFrame:
    """Basket and sales per 1000 m2 for rows of ``store_day_tickets``."""
    sized = tickets.join(stores.select("store_key", "open_m2"), "store_key", "left")
    baskets, area = (F.greatest(F.col(c), F.lit(1)) for c in ("ticket_count", "open_m2"))
    return sized.select(
        *tickets.columns,
        m.rounded_ratio("net_sales", baskets, 2).alias("avg_basket"),
        m.rounded_ratio(F.col("net_sales") * 1000, area, 2).alias("sales_m2"),
    )


def store_day(sales: DataFrame, day: str | None = None) -> DataFrame:
    """Article sales (any finer grain) to one row per day and store.

    ``day`` names a copy of the key that is taken by the aggregate: filters on what is derived from
    it stay above the rollup, where filters on the key itself would be tested on every line.
    """
    copy = [F.max("date_key").alias(day)] if day else []
    sums = [narrow_sum(sales, c).alias(c) for c in STORE_DAY_MEASURES]
    return sales.groupBy("date_key", "store_key").agg(*sums, *copy)


def period_actuals(store_days: DataFrame) -> DataFrame:
    return totals(store_days, ["commerce_period", "store_key"], {"net_sales": "actual_sales"})


def period_starts(calendar: DataFrame) -> DataFrame:
    """Every commerce period with its first day."""
    return calendar.groupBy("commerce_period").agg(
        F.min("date_value").alias("calendar_month_start")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
