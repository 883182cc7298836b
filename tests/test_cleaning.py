import datetime as dt
from decimal import Decimal as Dec

from helpers import rows
from pyspark.sql import functions as F

from tillwork.operators.columns import cast_keys, cast_money, drop_lineage, keys_first, up_to
from tillwork.operators.dedupe import keep_first
from tillwork.plans import entities


def text(spark, columns, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{c} string" for c in columns.split()))


def test_store(spark):
    raw = text(
        spark, "store_key open_m2 open_date status",
        ("1", "100", "2020-02-01", "Active"),
        ("2", "x", "2020-02-30", "Closed"),
        ("3", None, None, None),
        ("3", "7", "2021-01-01", "Planned"),
    )
    assert rows(entities.STORE.cleaned(raw)) == [
        (1, 100, dt.date(2020, 2, 1), "Active"),
        (2, None, None, "Unknown"),
        (3, None, None, "Unknown"),
    ]


def test_product(spark):
    raw = text(
        spark, "product_key ean retail_price unit_cost uom barcode_weight_kg",
        ("7", "123456789", "12.5", "1e", " kg ", ""),
        ("8", "12345678901234", "3", "2.99999", "pack", "1.2345"),
    )
    assert rows(entities.PRODUCT.cleaned(raw)) == [
        (7, "0000123456789", Dec("12.5"), None, "KG", None),
        (8, "12345678901234", Dec("3"), Dec("3"), "PACK", Dec("1.235")),
    ]


def test_pos_flags(spark):
    raw = text(
        spark,
        "txn_id line_id txn_date store_key product_key unit_qty is_promo payment_type channel "
        "gross_amount discount_amount net_amount tax_amount cost_amount",
        *[
            (str(i), "1", "2025-01-01", "1", "1", "1", flag, " cash", "Pos ", *["1"] * 5)
            for i, flag in enumerate(["true", " TRUE", "false", "yes", None])
        ],
    )
    got = entities.POS_LINE.cleaned(raw)
    flags = [r.is_promo for r in got.orderBy("txn_id").collect()]
    assert flags == [True, True, False, False, None]
    assert {(r.payment_type, r.channel) for r in got.collect()} == {("CASH", "POS")}


def test_inventory_and_budget_labels(spark):
    columns = (
        "date_key store_key product_key on_hand_qty received_qty sold_qty adjusted_qty "
        "in_transit_qty stock_state on_hand_cost unit_cost retail_price"
    )
    raw = text(
        spark, columns,
        *[("20250101", str(i), "1", *["1"] * 5, s, *["1"] * 3) for i, s in enumerate(["X", None, "IN_STOCK"])],
    )
    got = entities.INVENTORY.cleaned(raw).orderBy("store_key").collect()
    assert [r.stock_state for r in got] == ["UNKNOWN", "UNKNOWN", "IN_STOCK"]
    plan = text(
        spark, "commerce_period store_key dept budget_amount budget_qty_units calendar_month_start",
        ("2025-06", "1", " grocery ", "10", "2", "2025-05-26"),
        ("2025-06", "1", "GROCERY", "11", "2", "2025-05-26"),
    )
    kept = entities.BUDGET.cleaned(plan).collect()
    assert [(r.commerce_period, r.dept, r.budget_amount) for r in kept] == [
        ("2025-06", "Grocery", Dec("10"))
    ]


def test_malformed_numbers_become_null_and_fail_the_suite(spark):
    raw = text(
        spark,
        "date_key store_key product_key unit_qty gross_sales net_sales discount_amount "
        "tax_amount cost_amount ticket_count line_count promo_line_count",
        ("20250101", "one", "1", *["1"] * 9),
        ("20250101", "1", "1", "1", "1", "-5", *["1"] * 6),
    )
    cleaned = entities.DAILY_SALES.cleaned(raw)
    assert [r["store_key"] for r in entities.DAILY_SALES.rejected(raw).collect()] == ["one"]
    failed = entities.DAILY_SALES.checked(cleaned).where("not passed")
    assert [(r["expectation_type"], r["column"]) for r in failed.collect()] == [
        ("expect_column_values_to_be_between", "net_sales"),
        ("overall", ""),
    ]


def test_own_cleaner_and_checks(spark):
    mine = entities.Entity("src", "dst", ("k",), {}, (), clean=lambda df: df.where("k > 1"))
    assert mine.cleaned(spark.range(4).withColumnRenamed("id", "k")).count() == 2
    assert mine.checked(spark.range(1)).collect()[0].observed == "0/0 failed"


def test_columns(spark):
    df = text(spark, "a b _load_id", ("1", "2.55555", "x"), ("z", "", "x"))
    typed = cast_money(cast_keys(df, ["a"]), ["b"])
    assert rows(drop_lineage(typed)) == [(None, None), (1, Dec("2.5556"))]
    assert keys_first(df, ["b"]).columns == ["b", "a", "sil_updated_ts"]
    days = spark.createDataFrame([(20240101,), (20240102,)], "date_key bigint")
    assert up_to(days, "2024-01-01").count() == 1 and up_to(days, None).count() == 2


def test_dedupe_is_deterministic_and_null_first(spark):
    data = [(1, "b", 2), (1, None, 3), (1, "a", 1), (None, "q", 1), (None, "p", 1)]
    df = spark.createDataFrame(data, "k int, a string, b int")
    want = [(None, "p", 1), (1, None, 3)]
    for n in (1, 3, 7):
        assert rows(keep_first(df.repartition(n), ["k"])) == want
    assert rows(keep_first(df.withColumn("a", F.lit(1)), ["k"], ["b"])) == [(None, 1, 1), (1, 1, 1)]
