"""The star schema: three dimensions and four facts, each one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.retail_calendar import attach_calendar, day_of_key
from ..operators import joins, rollups
from ..operators.balances import Balance, not_negative, reconcile, total
from ..operators.columns import up_to
from ..operators.running import with_running_totals

# The published columns of each table.
DIM_STORE = (
    "store_key", "store_code", "name", "chain_format", "region",
    "city", "address", "open_m2", "open_date", "status",
)
DIM_PRODUCT = (
    "product_key", "sku", "ean", "name", "brand", "category", "dept",
    "uom", "retail_price", "unit_cost", "barcode_weight_kg",
)
DIM_CALENDAR = (
    "date_key", "date_value", "commerce_year", "commerce_quarter", "commerce_month",
    "commerce_period", "commerce_week", "quarter_week", "iso_week", "day_of_week",
    "day_name", "is_weekend", "date_key_sss", "date_key_mc",
)
FACT_SALES = (
    "date_key", "store_key", "product_key", "sku", "unit_qty", "gross_sales", "net_sales",
    "discount_amount", "tax_amount", "cost_amount", "margin_amount", "margin_pct",
    "ticket_count", "line_count", "promo_line_count",
)
FACT_STORE_DAY = (
    "date_key", "date_value", "commerce_year", "commerce_quarter", "commerce_month",
    "commerce_period", "date_key_sss", "date_key_mc", "store_key", "chain_format", "open_m2",
    "unit_qty", "gross_sales", "net_sales", "discount_amount", "tax_amount", "cost_amount",
    "promo_line_count", "ticket_count", "transaction_count", "traffic_estimate",
    "mtd_sales", "ytd_sales", "discount_rate", "avg_basket", "sales_m2",
    "net_sales_sss", "unit_qty_sss", "ticket_count_sss", "sss_variation_pct",
)
STORE_DAY_BASE = FACT_STORE_DAY[:FACT_STORE_DAY.index("mtd_sales")]
MONTH_CLOSE = ("net_sales_mc", "mc_variation_pct")
FACT_INVENTORY = (
    "date_key", "store_key", "product_key", "sku", "on_hand_qty", "on_hand_cost",
    "received_qty", "sold_qty", "adjusted_qty", "in_transit_qty", "stock_state",
    "unit_cost", "retail_price", "days_on_hand", "sell_through_pct", "stock_value",
)
FACT_BUDGET = (
    "commerce_period", "calendar_month_start", "store_key", "dept", "budget_amount",
    "budget_qty_units", "actual_sales", "budget_usage_pct", "budget_gap",
)
STORE_DAY_CALENDAR = DIM_CALENDAR[1:6] + DIM_CALENDAR[-2:]
SSS_VALUES = {
    "net_sales": "net_sales_sss",
    "unit_qty": "unit_qty_sss",
    "ticket_count": "ticket_count_sss",
}


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(*DIM_STORE)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*DIM_PRODUCT)


def dim_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.select(*DIM_CALENDAR)


def fact_sales(daily_sales: DataFrame) -> DataFrame:
    """Article sales per day and store with margins; a map-only projection."""
    return daily_sales.withColumns(
        {
            "margin_amount": m.margin_amount("net_sales", "cost_amount"),
            "margin_pct": m.margin_pct("net_sales", "cost_amount"),
        }
    ).select(*FACT_SALES)


def store_day_base(
    sales: DataFrame,
    stores: DataFrame,
    kpi: DataFrame,
    calendar: DataFrame | None = None,
    as_of: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Sales per day and store with calendar, store and ticket attributes.

    ``sales`` may have any grain finer than (day, store). Without a ``calendar``
    table its attributes are computed from the key and keys that are no day drop
    out; with one, days that it does not hold drop out. Stores that ``stores`` does not hold drop out in any case.

    The fact is rolled up before it joins, so a hot store joins as one row a day.
    Tickets join first, on the keys the rollup is already partitioned by; stores
    join last, so a sort-merge join there leaves the partitioning by store that
    the windows need. Days are read from their keys once for each store and day, above the rollup.

    With ``buckets`` the store days move to that many partitions of stores before calendar and stores
    join, which is where windows and a table of as many buckets want them, and move no more.
    """
    days = rollups.store_day(up_to(sales, as_of), "_day")
    tickets = ["ticket_count", "transaction_count", "traffic_estimate"]
    days = joins.join_dimension(
        days, up_to(kpi, as_of), ["date_key", "store_key"], tickets, "left"
    )
    if buckets:
        days = days.repartition(buckets, "store_key")
    if calendar is None:
        dated = days.withColumn("date_value", day_of_key("_day"))
        days = attach_calendar(
            dated.where(F.col("date_value").isNotNull()), "date_value", STORE_DAY_CALENDAR
        )
    else:
        days = joins.join_calendar(days, calendar, STORE_DAY_CALENDAR)
    days = days.drop("_day")
    return joins.join_dimension(days, stores, "store_key", ["chain_format", "open_m2"])


def fact_store_day(
    sales: DataFrame,
    stores: DataFrame,
    kpi: DataFrame,
    calendar: DataFrame | None = None,
    as_of: str | None = None,
    month_close: bool = False,
    self_join: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Store-day fact: running totals, ratios and the same day a year ago.

    The year-ago values come from a range frame over each store's days, which
    shares its exchange with the running totals; ``self_join`` takes them by a
    join of keys instead. Both see only days that survive ``as_of`` and the
    inner joins. ``month_close`` adds the same calendar date a year ago. ``buckets`` is as in
    ``store_day_base``, for a fact that is written in buckets.
    """
    return with_store_day_measures(
        store_day_base(sales, stores, kpi, calendar, as_of, buckets), month_close, self_join
    )


def with_store_day_measures(
    df: DataFrame, month_close: bool = False, self_join: bool = False
) -> DataFrame:
    """The fact's columns from its base: running totals, ratios, values of a year ago."""
    if self_join:
        df = joins.year_ago_by_join(df, "store_key", "date_key", "date_key_sss", SSS_VALUES)
    else:
        df = joins.year_ago_by_window(df, "store_key", "date_value", SSS_VALUES)
    if month_close:
        df = joins.month_close_by_window(
            df, "store_key", "date_key", {"net_sales": "net_sales_mc"}
        ).withColumn("mc_variation_pct", m.variation_pct("net_sales", "net_sales_mc"))
    df = with_running_totals(
        df, "net_sales", "store_key", "commerce_year", "commerce_month", "date_key"
    )
    df = df.withColumns(
        {
            "discount_rate": m.discount_rate("discount_amount", "gross_sales"),
            "avg_basket": m.avg_basket("net_sales", "ticket_count"),
            "sales_m2": m.sales_m2("net_sales", "open_m2"),
            "sss_variation_pct": m.variation_pct("net_sales", "net_sales_sss"),
        }
    )
    return df.select(*FACT_STORE_DAY, *(MONTH_CLOSE if month_close else ()))


def fact_inventory(inventory: DataFrame) -> DataFrame:
    """Stock per day, store and article with coverage measures; map-only."""
    return inventory.withColumns(
        {
            "days_on_hand": m.days_on_hand("on_hand_qty", "sold_qty"),
            "sell_through_pct": m.sell_through_pct("sold_qty", "on_hand_qty"),
            "stock_value": m.stock_value("on_hand_qty", "unit_cost"),
        }
    ).select(*FACT_INVENTORY)


def fact_budget(budget: DataFrame, store_days: DataFrame) -> DataFrame:
    """Budget against the actuals of the period and store.

    A store's actuals repeat on each of its departments, as published.
    """
    actuals = rollups.period_actuals(store_days)
    return _against(budget, actuals, ["commerce_period", "store_key"])


def fact_budget_by_dept(budget: DataFrame, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Budget against the actuals of the same department.

    Sales are totalled per article and period before products join.
    """
    dated = attach_calendar(
        sales.withColumn("date_value", day_of_key("date_key")), "date_value", ("commerce_period",)
    )
    by_article = rollups.totals(
        dated, ["commerce_period", "store_key", "product_key"], ["net_sales"]
    )
    named = joins.join_dimension(by_article, products, "product_key", ["dept"])
    keys = ["commerce_period", "store_key", "dept"]
    return _against(budget, rollups.totals(named, keys, {"net_sales": "actual_sales"}), keys)


def _against(budget: DataFrame, actuals: DataFrame, keys: list[str]) -> DataFrame:
    return (
        budget.join(actuals, keys, "left")
        .withColumns(
            {
                "budget_usage_pct": m.budget_usage_pct("actual_sales", "budget_amount"),
                "budget_gap": m.budget_gap("actual_sales", "budget_amount"),
            }
        )
        .select(*FACT_BUDGET)
    )


# Names and tolerance of the published layer balances.
LAYER_TOLERANCE = 0.001
BALANCES = (
    Balance("silver vs gold fact_sales (net)", "daily_sales", "fact_sales", LAYER_TOLERANCE),
    Balance("fact_sales vs store_daily (net)", "fact_sales", "store_day", LAYER_TOLERANCE),
    Balance("silver kpi vs store_daily (net)", "kpi", "store_day", LAYER_TOLERANCE),
)
BUDGET_SANITY = "budget sanity (amount>0)"


def layer_balances(
    daily_sales: DataFrame,
    sales: DataFrame,
    store_days: DataFrame,
    kpi: DataFrame,
    budget: DataFrame,
    as_of: str | None = None,
) -> DataFrame:
    """Net totals of neighbouring layers, and a sane budget total.

    ``as_of`` must be the cutoff the store-day fact was built with; it is applied
    to every side that is compared with it.
    """
    totals = total(up_to(daily_sales, as_of), "daily_sales", "net_sales")
    for label, df in (
        ("fact_sales", up_to(sales, as_of)),
        ("store_day", store_days),
        ("kpi", up_to(kpi, as_of)),
    ):
        totals = totals.unionByName(total(df, label, "net_sales"))
    plan = total(budget, "budget", "budget_amount")
    return reconcile(totals, BALANCES).unionByName(not_negative(plan, BUDGET_SANITY, "budget"))


def dropped_by_joins(sales: DataFrame, store_days: DataFrame) -> DataFrame:
    """Net sales that the inner joins of the store-day fact lost."""
    both = total(sales, "before", "net_sales").unionByName(total(store_days, "after", "net_sales"))
    sides = both.agg(
        F.sum(F.when(F.col("label") == "before", F.col("value"))).alias("before"),
        F.sum(F.when(F.col("label") == "after", F.col("value"))).alias("after"),
    )
    return sides.withColumn("lost", F.col("before") - F.col("after"))
