"""The declared variant of the sales chain: gated rows, margin, simple store-day.

It differs from the star on purpose: fewer measures, the gate on the rows
themselves, and a left join to the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.joins import join_calendar
from ..operators.rollups import totals
from ..operators.running import with_running_totals

KEYS = ("date_key", "store_key", "product_key")
VALID_KEYS = " AND ".join(f"{k} IS NOT NULL" for k in KEYS)


def gated_sales(raw: DataFrame) -> DataFrame:
    """Typed sales with margin. Rows without keys drop, negative sales fail."""
    typed = raw.selectExpr(
        *[f"try_cast({k} AS bigint) AS {k}" for k in KEYS],
        "try_cast(unit_qty AS int) AS unit_qty",
        *[
            f"try_cast({c} AS decimal(18,4)) AS {c}"
            for c in ("gross_sales", "net_sales", "tax_amount", "cost_amount")
        ],
    )
    gated = q.require(
        q.keep_valid(typed, F.expr(VALID_KEYS)),
        F.col("net_sales") >= 0,
        "net_sales_non_negative",
    )
    return gated.selectExpr("*", "round(net_sales - cost_amount, 4) AS margin_amount")


def store_day(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Net sales and units per day and store with running totals.

    Days outside the calendar stay, with NULL calendar attributes. Days move to their stores before
    they get these, which the running totals then find there.
    """
    days = totals(sales, ["date_key", "store_key"], ["net_sales", "unit_qty"]).repartition("store_key")
    dated = join_calendar(
        days, calendar, ["commerce_period", "commerce_year", "date_key_sss"], how="left"
    )
    return with_running_totals(
        dated, "net_sales", "store_key", "commerce_year", "commerce_period", "date_key"
    )
