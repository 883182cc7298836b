import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwork.operators import rollups

LINES = """txn_id string, txn_date date, store_key bigint, product_key bigint, sku string, unit_qty int,
    gross_amount decimal(18,4), net_amount decimal(18,4), discount_amount decimal(18,4),
    tax_amount decimal(18,4), cost_amount decimal(18,4), is_promo boolean"""
DAY = dt.date(2025, 1, 1)


def partial_types(df):
    """Types of what the first aggregate of the plan hands on."""
    node, found = df._jdf.queryExecution().sparkPlan(), None
    while True:
        if node.nodeName().endswith("Aggregate"):
            found = node
        if node.children().isEmpty():
            return [f["type"] for f in json.loads(found.schema().json())["fields"]]
        node = node.children().apply(0)


@pytest.fixture
def lines(spark):
    def line(store, *money):
        return ("t", DAY, store, 1, "S", 1, *[None if m is None else Decimal(m) for m in money], True)

    most = "99999999999999.9999"
    return spark.createDataFrame(
        [
            line(1, "1.0001", "-0.0001", "0.9999", None, most),
            line(1, "2.9999", "-7.5000", "0.0001", None, most),
            line(1, None, "7.4999", "-3.0000", None, f"-{most}"),
            line(2, "0.0000", None, f"-{most}", "0.0001", most),
        ]
        + [line(3, most, f"-{most}", "0.9999", "1", "0")] * 50,
        LINES,
    )


def test_narrow_sums_are_the_sums(lines):
    money = [c for c in rollups.LINE_MEASURES if c != "unit_qty"]
    plain = lines.groupBy("store_key").agg(*[F.sum(c).alias(c) for c in money])
    narrow = rollups.totals(lines, ["store_key"], money)
    assert narrow.dtypes == plain.dtypes and rows(narrow) == rows(plain)
    assert rows(rollups.totals(narrow, ["store_key"], money)) == rows(plain)


def test_rollups_hold_no_wide_decimals_before_the_shuffle(lines):
    sales = lines.selectExpr(
        "20250101L date_key", "store_key", "unit_qty", "gross_amount gross_sales", "net_amount net_sales",
        "discount_amount", "tax_amount", "cost_amount", "1 promo_line_count",
    )
    for rolled in (rollups.daily_sales(lines), rollups.store_day(sales)):
        kinds = [t for t in partial_types(rolled) if str(t).startswith("decimal")]
        assert [t for t in kinds if int(t[8:].split(",")[0]) > 18] == []
