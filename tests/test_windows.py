import datetime as dt

from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.functions.retail_calendar import attach_calendar, date_key
from tillwork.operators import joins, running

flows = st.lists(st.lists(st.integers(-9, 9), min_size=1, max_size=25), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(flows)
def test_ledger_equals_a_loop(spark, ledgers):
    data, want = [], {}
    for item, moves in enumerate(ledgers):
        held = item % 5
        for day, move in enumerate(moves):
            held = max(0, held + move)
            data.append((item, day, move, item % 5))
            want[item, day] = held
    df = spark.createDataFrame(data, "item int, day int, move int, base int")
    got = running.clamped_balance(df, ["item"], "day", F.col("move"), F.col("base"), "held")
    assert {(r.item, r.day): r.held for r in got.collect()} == want


def test_ledger_example(spark):
    df = spark.createDataFrame([(1, 1, -3), (1, 2, 5), (1, 3, -1)], "item int, day int, move int")
    got = running.clamped_balance(df, ["item"], "day", F.col("move"), F.lit(2), "held")
    assert [r.held for r in got.orderBy("day").collect()] == [0, 5, 4]
    assert plan(got).count("Exchange") == 1 and plan(got).count("Sort [") == 1


def store_days(spark, stores, start, n, skip):
    data = [
        (s, start + dt.timedelta(i), s * 1000 + i)
        for s in range(stores)
        for i in range(n)
        if (s + i) % skip
    ]
    df = spark.createDataFrame(data, "store_key int, date_value date, net_sales int")
    return df.withColumn("date_key", date_key("date_value"))


def test_year_ago_forms_agree_with_a_lookup(spark):
    df = store_days(spark, 3, dt.date(2022, 12, 1), 500, 7)
    values = {"net_sales": "before"}
    keyed = joins.with_comparison_keys(df, "date_value")
    by_join = joins.year_ago_by_join(keyed, "store_key", "date_key", "date_key_sss", values)
    by_frame = joins.year_ago_by_window(keyed, "store_key", "date_value", values)
    held = {(r.store_key, r.date_value): r.net_sales for r in df.collect()}
    want = sorted((s, d, held.get((s, d - dt.timedelta(364)))) for s, d in held)
    for got in (by_join, by_frame):
        assert sorted((r.store_key, r.date_value, r.before) for r in got.collect()) == want


def test_month_close_clamps_leap_day(spark):
    df = store_days(spark, 1, dt.date(2023, 2, 26), 372, 10_000)
    got = joins.month_close_by_window(df, "store_key", "date_key", {"net_sales": "mc"})
    by_key = {r.date_key: r.mc for r in got.collect()}
    held = {r.date_key: r.net_sales for r in df.collect()}
    assert by_key[20240228] == by_key[20240229] == held[20230228]
    assert by_key[20240301] == held[20230301] and by_key[20230301] is None


def test_running_totals(spark):
    df = attach_calendar(
        store_days(spark, 2, dt.date(2024, 12, 20), 60, 5),
        "date_value",
        ("commerce_year", "commerce_month"),
    )
    got = running.with_running_totals(
        df, "net_sales", "store_key", "commerce_year", "commerce_month", "date_key"
    )
    assert plan(got).count("Exchange") == 1 and plan(got).count("Sort [") == 1
    month, year = {}, {}
    for r in got.orderBy("store_key", "date_key").collect():
        y, m = (r.store_key, r.commerce_year), (r.store_key, r.commerce_year, r.commerce_month)
        year[y] = year.get(y, 0) + r.net_sales
        month[m] = month.get(m, 0) + r.net_sales
        assert (r.mtd_sales, r.ytd_sales) == (month[m], year[y])


def test_calendar_joins(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (9, 7)], "date_key bigint, v int")
    cal = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "date_key bigint, w string")
    assert rows(joins.join_calendar(df, cal, ["w"])) == [(1, 5, "a"), (2, 6, "b")]
    left = joins.join_calendar(df, cal, ["date_key", "w"], how="left")
    assert rows(left)[-1] == (9, 7, None)
