"""The eight retail entities: cleaning rules, business keys, quality suites.

An entity is data. Users extend the set by adding an ``Entity`` with their own
rules, or a ``clean`` callable of their own (DataFrame to DataFrame).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as c
from ..functions.measures import STOCK_STATES
from ..operators import quality as q
from ..operators.columns import LINEAGE_COLUMNS, apply_rules, drop_lineage
from ..operators.dedupe import keep_first, keep_last

# Value lists the suites and the cleaning rules refer to.
STORE_STATUSES = ("Active", "Planned")
CHAIN_FORMATS = ("hyper", "super", "express")
CATEGORIES = (
    "Fresh", "Dairy", "Bakery", "Beverages", "Snacks",
    "Pantry", "Household", "PersonalCare", "Electronics", "Clothing",
)
EAN_WIDTH = 13

# Lineage columns that tell which delivery of a row is the newer one.
DELIVERY = ("_ingestion_ts", "_arrived")

# The table names, keys and suite contents of the entities below are fixed values
# as well: they are what users of the published tables rely on.


def _all(rule: c.Rule, *columns: str) -> dict[str, c.Rule]:
    return dict.fromkeys(columns, rule)


def _without_idle_lineage(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """``raw`` without the lineage that decides nothing: what stands behind the last other column
    could only choose between rows that are equal without it. File names are long, so that rows
    with them fill the memory of the sorts."""
    names = list(raw.columns)
    while names and names[-1] in LINEAGE_COLUMNS:
        names.pop()
    return raw.drop(*(c for c in raw.columns[len(names):] if c not in order))


@dataclass(frozen=True)
class Entity:
    """How raw rows of one kind become typed, unique and checked rows."""

    source: str
    table: str
    keys: Sequence[str]
    rules: Mapping[str, c.Rule]
    checks: Sequence[q.Check]
    clean: Callable[[DataFrame], DataFrame] | None = None

    def cleaned(self, raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """Typed rows, one for each key; of several the last in ``order``, as far as ``raw``
        has these columns. Rows whose key cannot be read are not in it, see ``rejected``."""
        if self.clean is not None:
            return self.clean(raw)
        present = [c for c in order if c in raw.columns]
        typed = apply_rules(_without_idle_lineage(raw, present), self.rules).where(self._keyed())
        return drop_lineage(
            keep_last(typed, self.keys, present) if present else keep_first(typed, self.keys)
        )

    def rejected(self, raw: DataFrame) -> DataFrame:
        """Raw rows as they came whose key, once typed, is NULL in part or as a whole."""
        rules = {k: self.rules[k] for k in self.keys if k in self.rules}
        marked = raw.withColumns({f"_typed_{k}": rules[k](k) if k in rules else F.col(k) for k in self.keys})
        return marked.where(~self._keyed("_typed_")).select(*raw.columns)

    def _keyed(self, prefix: str = "") -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"{prefix}{k}").isNotNull() for k in self.keys])

    def checked(self, df: DataFrame, threshold: float = q.DEFAULT_THRESHOLD) -> DataFrame:
        return q.evaluate(df, self.checks, threshold)

    def with_checks(self, *checks: q.Check) -> Entity:
        return replace(self, checks=checks)


STORE = Entity(
    source="brz_stores_master",
    table="sil_store",
    keys=("store_key",),
    rules={
        "store_key": c.key,
        "open_m2": c.integer,
        "open_date": c.day,
        "status": c.one_of(STORE_STATUSES, "Unknown"),
    },
    checks=(q.not_null("store_key"), q.row_count(1), q.contains("chain_format", CHAIN_FORMATS)),
)

PRODUCT = Entity(
    source="brz_products_master",
    table="sil_product",
    keys=("product_key",),
    rules={
        "product_key": c.key,
        "ean": c.left_padded(EAN_WIDTH),
        **_all(c.money, "retail_price", "unit_cost"),
        "uom": c.code,
        "barcode_weight_kg": c.weight,
    },
    checks=(
        q.not_null("product_key"),
        q.not_null("sku"),
        q.contains("category", CATEGORIES),
        q.row_count(1),
    ),
)

CALENDAR = Entity(
    source="brz_calendar_445",
    table="sil_calendar_445",
    keys=("date_key",),
    rules={
        **_all(c.key, "date_key", "date_key_sss", "date_key_mc"),
        "date_value": c.day,
        **_all(
            c.integer,
            "commerce_year", "commerce_quarter", "commerce_month", "commerce_week",
            "quarter_week", "iso_week",
        ),
    },
    checks=(
        q.not_null("date_key"),
        q.between("commerce_month", 1, 12),
        q.between("commerce_quarter", 1, 4),
        q.between("commerce_week", 1, 53),
    ),
)

DAILY_SALES = Entity(
    source="brz_sales_daily_store_sku",
    table="sil_daily_sales",
    keys=("date_key", "store_key", "product_key"),
    rules={
        **_all(c.key, "date_key", "store_key", "product_key"),
        **_all(c.integer, "unit_qty", "ticket_count", "line_count", "promo_line_count"),
        **_all(
            c.money,
            "gross_sales", "net_sales", "discount_amount", "tax_amount", "cost_amount",
        ),
    },
    checks=(
        q.not_null("date_key"),
        q.not_null("store_key"),
        q.not_null("product_key"),
        q.between("net_sales", 0.0),
        q.row_count(1),
    ),
)

POS_LINE = Entity(
    source="brz_pos_line_items",
    table="sil_pos_line",
    keys=("txn_id", "line_id"),
    rules={
        "txn_date": c.day,
        **_all(c.integer, "line_id", "unit_qty"),
        **_all(c.key, "store_key", "product_key"),
        "is_promo": c.flag,
        **_all(c.code, "payment_type", "channel"),
        **_all(
            c.money,
            "gross_amount", "discount_amount", "net_amount", "tax_amount", "cost_amount",
        ),
    },
    checks=(
        q.not_null("txn_id"),
        q.not_null("txn_date"),
        q.between("net_amount", 0.0),
        q.row_count(1),
    ),
)

STORE_KPI = Entity(
    source="brz_store_daily_kpi",
    table="sil_store_daily_kpi",
    keys=("date_key", "store_key"),
    rules={
        **_all(c.key, "date_key", "store_key"),
        **_all(c.integer, "ticket_count", "transaction_count", "traffic_estimate"),
        **_all(c.money, "avg_basket", "sales_m2", "gross_sales", "net_sales"),
    },
    checks=(
        q.not_null("date_key"),
        q.not_null("store_key"),
        q.between("net_sales", 0.0),
        q.row_count(1),
    ),
)

INVENTORY = Entity(
    source="brz_daily_inventory",
    table="sil_daily_inventory",
    keys=("date_key", "store_key", "product_key"),
    rules={
        **_all(c.key, "date_key", "store_key", "product_key"),
        **_all(
            c.integer,
            "on_hand_qty", "received_qty", "sold_qty", "adjusted_qty", "in_transit_qty",
        ),
        "stock_state": c.one_of(STOCK_STATES, "UNKNOWN"),
        **_all(c.money, "on_hand_cost", "unit_cost", "retail_price"),
    },
    checks=(
        q.not_null("store_key"),
        q.not_null("product_key"),
        q.between("on_hand_qty", 0.0),
        q.contains("stock_state", STOCK_STATES),
        q.row_count(1),
    ),
)

BUDGET = Entity(
    source="brz_budget",
    table="sil_budget",
    keys=("commerce_period", "store_key", "dept"),
    rules={
        "calendar_month_start": c.day,
        "store_key": c.key,
        "budget_qty_units": c.integer,
        "dept": c.title,
        "budget_amount": c.money,
    },
    checks=(
        q.not_null("commerce_period"),
        q.not_null("store_key"),
        q.between("budget_amount", 0.0),
        q.row_count(1),
    ),
)

ENTITIES = (STORE, PRODUCT, CALENDAR, DAILY_SALES, POS_LINE, STORE_KPI, INVENTORY, BUDGET)
