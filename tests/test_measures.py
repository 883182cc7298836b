from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from tillwork.functions import measures as m

CASES = [
    ("margin_pct", ("0", "5"), 0),
    ("margin_pct", ("3", "1"), Dec("0.666667")),
    ("margin_pct", (None, "1"), 0),
    ("margin_amount", ("10.5", "4.25"), Dec("6.25")),
    ("discount_rate", ("1", "0"), 0),
    ("discount_rate", ("1", "4"), 0.25),
    ("avg_basket", ("10", None), 0),
    ("avg_basket", ("10", "0"), 0),
    ("avg_basket", ("10", "4"), 2.5),
    ("sales_m2", ("10", "0"), 0),
    ("sales_m2", ("10", "8"), 1.25),
    ("variation_pct", ("10", None), None),
    ("variation_pct", ("10", "0"), None),
    ("variation_pct", ("10", "8"), Dec("0.25")),
    ("variation_pct", ("1", "3"), Dec("-0.666667")),
    ("days_on_hand", ("10", None), None),
    ("days_on_hand", ("10", "0"), None),
    ("days_on_hand", ("1", "8"), Dec("0.13")),
    ("sell_through_pct", ("0", "0"), 0),
    ("sell_through_pct", ("1", "2"), Dec("0.333333")),
    ("budget_usage_pct", ("5", "0"), None),
    ("budget_usage_pct", (None, "5"), None),
    ("budget_usage_pct", ("5", "4"), Dec("1.25")),
    ("budget_gap", (None, "5"), None),
    ("budget_gap", ("5", None), None),
    ("budget_gap", ("5", "7"), Dec("-2")),
    ("on_hand_cost", ("3", "1.115"), Dec("3.35")),
    ("line_discount", ("9.99", "0.15"), Dec("1.50")),
    ("line_cost", ("1.25", "3"), Dec("3.75")),
]


@pytest.mark.parametrize("name,args,want", CASES)
def test_branches(spark, name, args, want):
    values = [F.lit(a).cast("decimal(18,4)") for a in args]
    got = spark.range(1).select(getattr(m, name)(*values)).first()[0]
    assert got == want


def test_contained_tax(spark):
    got = spark.range(1).select(m.contained_tax(F.lit("119").cast("decimal(18,4)"))).first()[0]
    assert got == Dec("19.00")


def test_line_gross(spark):
    df = spark.createDataFrame(
        [(Dec("2.50"), 3, "EA", None), (Dec("2.50"), 1, "KG", Dec("0.333"))],
        "price decimal(18,4), qty int, uom string, kg decimal(10,3)",
    )
    got = [r[0] for r in df.select(m.line_gross("price", "qty", "uom", "kg")).collect()]
    assert got == [Dec("7.5"), Dec("0.83")]


def test_stock_state(spark):
    df = spark.createDataFrame([(5,), (4,), (1,), (0,)], "n int")
    got = [r[0] for r in df.select(m.stock_state("n")).collect()]
    assert got == ["IN_STOCK", "LOW_STOCK", "LOW_STOCK", "OUT_OF_STOCK"]


def test_ratio_of_large_totals_keeps_its_places(spark):
    big = [F.lit(x).cast("decimal(38,4)") for x in ("123456789012345.1234", "987654321098765.4321")]
    got = spark.range(1).select(m.rounded_ratio(*big, 6)).first()[0]
    assert got == round(Dec("123456789012345.1234") / Dec("987654321098765.4321"), 6)
