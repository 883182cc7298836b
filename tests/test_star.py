import datetime as dt
from decimal import Decimal as Dec

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.operators import quality as q
from tillwork.operators.calendar import commerce_calendar
from tillwork.plans import declared, star
from tillwork.sources import sinks

D = dt.date


def sales_of(spark, *data):
    """(date_key, store, article, net) with fixed other measures."""
    df = spark.createDataFrame(list(data), "date_key bigint, store_key bigint, product_key bigint, net int")
    money = F.col("net").cast("decimal(18,4)")
    return df.select(
        "date_key", "store_key", "product_key",
        F.lit(2).alias("unit_qty"),
        (money * 2).cast("decimal(18,4)").alias("gross_sales"),
        money.alias("net_sales"),
        money.alias("discount_amount"), money.alias("tax_amount"), money.alias("cost_amount"),
        F.lit(1).alias("promo_line_count"),
    )


@pytest.fixture(scope="module")
def parts(spark):
    sales = sales_of(
        spark,
        (20240104, 1, 1, 10), (20240104, 1, 2, 30), (20250102, 1, 1, 50), (20250103, 1, 1, 7),
        (20250102, 2, 1, 9), (20250102, 99, 1, 5),
    )
    stores = spark.createDataFrame(
        [(1, "hyper", 100), (2, "super", 0)], "store_key bigint, chain_format string, open_m2 int"
    )
    kpi = spark.createDataFrame(
        [(20240104, 1, 4), (20250102, 1, 0)], "date_key bigint, store_key bigint, ticket_count int"
    ).selectExpr("*", "ticket_count transaction_count", "10 traffic_estimate")
    return sales, stores, kpi


@pytest.mark.parametrize("self_join", [False, True])
@pytest.mark.parametrize("with_table", [False, True])
def test_store_day_fact(spark, parts, self_join, with_table):
    cal = commerce_calendar(spark, D(2024, 1, 1), D(2025, 12, 31)) if with_table else None
    got = star.fact_store_day(*parts, calendar=cal, self_join=self_join)
    assert got.columns == list(star.FACT_STORE_DAY)
    picked = got.select(
        "date_key", "store_key", "net_sales", "mtd_sales", "ytd_sales", "avg_basket",
        "sales_m2", "discount_rate", "net_sales_sss", "ticket_count_sss", "sss_variation_pct",
    )
    assert rows(picked) == [
        (20240104, 1, 40, 40, 40, 10.0, 0.4, 0.5, None, None, None),
        (20250102, 1, 50, 50, 50, 0.0, 0.5, 0.5, 40, 4, Dec("0.25")),
        (20250102, 2, 9, 9, 9, 0.0, 0.0, 0.5, None, None, None),
        (20250103, 1, 7, 57, 57, 0.0, 0.07, 0.5, None, None, None),
    ]


def test_calendar_table_and_cutoff_limit_the_days(spark, parts):
    only_2025 = commerce_calendar(spark, D(2025, 1, 1), D(2025, 12, 31))
    cut = star.fact_store_day(*parts, calendar=only_2025)
    assert cut.where("net_sales_sss is not null").count() == 0 and cut.count() == 3
    early = star.fact_store_day(*parts, as_of="2025-01-02")
    assert early.agg(F.max("date_key")).first()[0] == 20250102


def test_month_close(spark, parts):
    sales = sales_of(spark, (20230228, 1, 1, 4), (20240229, 1, 1, 5))
    got = star.fact_store_day(sales, *parts[1:], month_close=True)
    assert rows(got.select("date_key", "net_sales_mc", "mc_variation_pct")) == [
        (20230228, None, None), (20240229, 4, Dec("0.25")),
    ]


def test_post_rollup_exchanges(spark, parts):
    """Rollup, then one exchange by store that serves the join and all windows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.fact_store_day(*parts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(store_key") == 2  # the fact and the stores
    assert text.count("Exchange hashpartitioning(date_key") == 2  # the rollup and the tickets


def test_budget_fact(spark):
    budget = spark.createDataFrame(
        [("2025-01", D(2025, 1, 6), 1, "A", Dec(8), 1), ("2025-01", D(2025, 1, 6), 1, "B", Dec(0), 1),
         ("2025-02", D(2025, 1, 27), 1, "A", Dec(5), 1)],
        "commerce_period string, calendar_month_start date, store_key bigint, dept string, "
        "budget_amount decimal(18,4), budget_qty_units int",
    )
    days = spark.createDataFrame(
        [("2025-01", 1, Dec(4)), ("2025-01", 1, Dec(6))],
        "commerce_period string, store_key bigint, net_sales decimal(18,4)",
    )
    got = star.fact_budget(budget, days).select(
        "commerce_period", "dept", "actual_sales", "budget_usage_pct", "budget_gap"
    )
    assert rows(got) == [
        ("2025-01", "A", 10, Dec("1.25"), 2),
        ("2025-01", "B", 10, None, 10),
        ("2025-02", "A", None, None, None),
    ]


def test_balances_show_lost_sales(spark, parts):
    sales, stores, kpi = parts
    days = star.store_day_base(sales, stores, kpi)
    kpi_net = days.select("date_key", "net_sales")
    budget = spark.range(1).selectExpr("1 budget_amount")
    got = {r.name: r.passed for r in star.layer_balances(sales, sales, days, kpi_net, budget).collect()}
    assert list(got.values()) == [True, False, True, True]
    assert rows(star.dropped_by_joins(sales, days)) == [(111.0, 106.0, 5.0)]


def test_declared_gate(spark):
    columns = "date_key store_key product_key unit_qty gross_sales net_sales tax_amount cost_amount"
    raw = [("20250102", "1", "1", "1", "5", "4.5", "1", "2"), (None, "1", "1", "1", "5", "4", "1", "2")]
    df = spark.createDataFrame(raw, ", ".join(f"{c} string" for c in columns.split()))
    assert rows(declared.gated_sales(df).select("date_key", "margin_amount")) == [
        (20250102, Dec("2.5"))
    ]
    for bad in ("-1", "x"):
        with pytest.raises(Exception, match="net_sales_non_negative"):
            declared.gated_sales(df.withColumn("net_sales", F.lit(bad))).collect()


def test_gate_raises(spark):
    checks = q.evaluate(spark.range(0), [q.row_count(1)])
    from tillwork.plans.layers import gate

    balances = spark.createDataFrame(
        [("net", 1.0, 1.0, 0.0, True)],
        "name string, expected double, actual double, diff_pct double, passed boolean",
    )
    with pytest.raises(q.QualityFailure, match="0 rows"):
        gate(checks, balances)
    verdict = gate(q.evaluate(spark.range(2), [q.row_count(1)]), balances)
    assert rows(verdict) == [(True, 3, 0)]


def test_day_is_not_parsed_beneath_the_rollup(spark):
    """The filter on valid days and the calendar are computed for store days, not for lines."""
    sales = sales_of(spark, (20250101, 1, 1, 5), (20250199, 1, 1, 5))
    stores = spark.createDataFrame([(1, "hyper", 10)], "store_key bigint, chain_format string, open_m2 int")
    kpi = spark.createDataFrame(
        [(20250101, 1, 2, 2, 3)],
        "date_key bigint, store_key bigint, ticket_count int, transaction_count int, traffic_estimate int",
    )
    days = star.fact_store_day(sales, stores, kpi)
    assert rows(days.select("date_key")) == [(20250101,)]
    optimized = plan(days, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "make_date" in optimized
    assert "make_date" not in optimized[optimized.index("Aggregate [") :]


def test_declared_days_move_to_their_stores_once(spark, schema):
    """The calendar's attributes do not travel, and stored tables are compressed with zstd."""
    sales = sales_of(spark, (20250101, 1, 1, 5), (20250102, 1, 2, 7), (20250102, None, 1, 9), (20300101, 2, 1, 4))
    table = sinks.append_rows(sales, f"{schema}.sold")
    assert all(".zstd." in f for f in spark.table(table).inputFiles())
    days = declared.store_day(spark.table(table), commerce_calendar(spark, D(2025, 1, 1), D(2025, 1, 31)))
    physical = plan(days)
    moved = physical[: physical.index("hashpartitioning(date_key")]
    assert moved.count("hashpartitioning(") == 1 and "hashpartitioning(store_key" in moved
    assert moved.index("Join") < moved.index("hashpartitioning(store_key")
    got = rows(days.select("date_key", "store_key", "mtd_sales", "ytd_sales", "commerce_year"))
    assert got == [
        (20250101, 1, 5, 5, 2025), (20250102, None, 9, 9, 2025), (20250102, 1, 7 + 5, 12, 2025), (20300101, 2, 4, 4, None),
    ]
