import datetime as dt
import re
from decimal import Decimal as Dec

import pytest
from helpers import plan, rows, shuffles_held
from pyspark.sql import functions as F

from tillwork.operators import joins
from tillwork.plans import star, store_days

STORES = (1, 2, 3)


def sales_of(spark, data):
    """(day, store, net) with fixed other measures."""
    df = spark.createDataFrame(list(data), "date_key bigint, store_key bigint, net int")
    money = F.col("net").cast("decimal(18,4)")
    return df.select(
        "date_key", "store_key",
        F.lit(2).alias("unit_qty"),
        *[money.alias(c) for c in ("gross_sales", "net_sales", "discount_amount", "tax_amount", "cost_amount")],
        F.lit(1).alias("promo_line_count"),
    )


def key(day):
    return day.year * 10_000 + day.month * 100 + day.day


@pytest.fixture(scope="module")
def sides(spark):
    stores = spark.createDataFrame(
        [(s, "hyper", 100) for s in STORES], "store_key bigint, chain_format string, open_m2 int"
    )
    kpi = spark.createDataFrame(
        [(key(dt.date(2023, 3, 1)), 1, 4)], "date_key bigint, store_key bigint, ticket_count int"
    ).selectExpr("*", "ticket_count transaction_count", "10 traffic_estimate")
    return stores, kpi


def every(step, first=dt.date(2021, 12, 20), last=dt.date(2025, 2, 10)):
    days = [first + dt.timedelta(n) for n in range(0, (last - first).days, step)]
    return {(key(d), s): 10 * s + d.day for d in days for s in STORES}


def listed(known):
    return [(d, s, net) for (d, s), net in known.items()]


def files_of(table):
    found = table.select("commerce_period", F.col("_metadata.file_path").alias("f")).distinct()
    out = {}
    for period, path in rows(found):
        out.setdefault(period, set()).add(path)
    return out


# Changes of store 1 alone: new values (None: the sales are gone). The first four are a day in
# mid-year, the 28th of February before a leap year's 29th, the first and last days of a year.
CHANGES = {
    "mid_year": {20230615: 999},
    "before_leap_day": {20230228: 500},
    "turn_of_year": {20221231: 70, 20230101: 71, 20230102: 72},
    "gone": {20230615: None, 20230616: None},
    "new_day_and_no_day": {20260301: 40, 20239999: 5},
    "several_years": {20220105: 1, 20241231: 2},
}


@pytest.mark.parametrize(
    "case, month_close", [*((c, True) for c in CHANGES), ("before_leap_day", False)]
)
def test_corrected_table_equals_a_rebuild(spark, schema, sides, case, month_close):
    known = every(1)
    before = star.fact_store_day(sales_of(spark, listed(known)), *sides, month_close=month_close)
    table = store_days.write_store_days(before, f"{schema}.days_{case}_{month_close}".lower(), buckets=4)
    old_files = files_of(spark.table(table))
    for day, net in CHANGES[case].items():
        known.pop((day, 1), None)
        if net is not None:
            known[day, 1] = net
    sales = sales_of(spark, listed(known))
    changed = spark.createDataFrame([(d, 1) for d in CHANGES[case]] * 2, "date_key bigint, store_key bigint")
    rewritten = store_days.correct_store_days(spark, table, changed, sales, *sides)
    want = star.fact_store_day(sales, *sides, month_close=month_close)
    got = spark.table(table).select(*want.columns)
    assert rows(got, "store_key", "date_key") == rows(want, "store_key", "date_key")
    new_files = files_of(spark.table(table))
    for period, files in old_files.items():
        assert (new_files.get(period) == files) == (period not in rewritten)
    assert set(old_files) - set(rewritten)


def test_period_without_days_left_goes(spark, schema, sides):
    known = {(20230110, 1): 5, (20230610, 1): 7, (20230612, 2): 9, (20230910, 1): 8}
    sales = sales_of(spark, listed(known))
    table = store_days.write_store_days(star.fact_store_day(sales, *sides), f"{schema}.emptied", buckets=2)
    less = sales.where("date_key <> 20230910")
    changed = sales.where("date_key = 20230910")
    assert store_days.correct_store_days(spark, table, changed, less, *sides) == ["2023-09"]
    assert rows(spark.table(table).select("date_key", "ytd_sales"), "date_key") == [
        (20230110, Dec(5)), (20230610, Dec(12)), (20230612, Dec(9)),
    ]
    places = spark.sql(f"SHOW PARTITIONS {table}").collect()
    assert len(places) == 2


def test_no_changes_rewrite_nothing(spark, schema, sides):
    sales = sales_of(spark, [(20230110, 1, 5)])
    table = store_days.write_store_days(star.fact_store_day(sales, *sides), f"{schema}.same", buckets=2)
    before = files_of(spark.table(table))
    assert store_days.correct_store_days(spark, table, sales.where("false"), sales, *sides) == []
    assert files_of(spark.table(table)) == before


def test_a_correction_can_be_run_again(spark, schema, sides):
    known = every(3)
    table = f"{schema}.again"
    store_days.write_store_days(star.fact_store_day(sales_of(spark, listed(known)), *sides), table, buckets=2)
    day = next(d for d, s in known if s == 1 and d // 100 == 202306)
    known[day, 1] = 12345
    sales = sales_of(spark, listed(known))
    changed = sales.where((F.col("date_key") == day) & (F.col("store_key") == 1))
    for _ in range(2):
        store_days.correct_store_days(spark, table, changed, sales, *sides)
    want = star.fact_store_day(sales, *sides)
    got = spark.table(table).select(*want.columns)
    assert rows(got, "store_key", "date_key") == rows(want, "store_key", "date_key")


def test_stored_store_days_need_no_exchange(spark, schema, sides):
    base = star.store_day_base(sales_of(spark, listed(every(9))), *sides)
    table = store_days.write_store_days(base, f"{schema}.bucketed", buckets=4)
    assert "Exchange" not in plan(store_days.fact_of_stored(spark.table(table), month_close=True))

    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = [spark.conf.get(name), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")]
    spark.conf.set(name, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked = joins.year_ago_by_join(
            spark.table(table), "store_key", "date_key", "date_key_sss", star.SSS_VALUES
        )
        shown = plan(looked)
        assert "SortMergeJoin" in shown and "Exchange" not in shown
    finally:
        spark.conf.set(name, old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])


def test_a_table_without_buckets_is_refused(spark, schema, sides):
    star.fact_store_day(sales_of(spark, [(20230110, 1, 5)]), *sides).write.saveAsTable(f"{schema}.flat")
    with pytest.raises(ValueError, match="not bucketed"):
        store_days.buckets_of(spark, f"{schema}.flat")


def test_buckets_follow_the_store_days(spark, schema, sides, monkeypatch):
    monkeypatch.setattr(store_days, "ROWS_PER_BUCKET", 100)
    known = dict.fromkeys(every(1, dt.date(2023, 1, 1), dt.date(2023, 9, 30)), 5)
    twice = sales_of(spark, listed(known) * 2)
    buckets = store_days.buckets_for(twice)
    assert 7 <= buckets <= 9  # 816 store days, estimated
    assert store_days.buckets_for(twice.where("date_key = 20230101")) == store_days.LEAST_BUCKETS
    assert store_days.buckets_for(twice.where("false")) == store_days.LEAST_BUCKETS
    table = store_days.write_store_days(star.store_day_base(twice, *sides), f"{schema}.sized", buckets=buckets)
    assert store_days.buckets_of(spark, table) == buckets
    assert rows(store_days.fact_of_stored(spark.table(table)), "date_key", "store_key") == rows(
        star.fact_store_day(twice, *sides), "date_key", "store_key"
    )


def test_a_dealt_fact_moves_to_its_stores_once(spark, schema, sides):
    known = sales_of(spark, listed(every(5)))
    fact = star.fact_store_day(known, *sides, month_close=True, buckets=4)
    # The fact and the stores, in as many partitions as the table has buckets.
    assert re.findall(r"Exchange hashpartitioning\(store_key#\d+L, (\d+)\)", plan(fact)) == ["4", "4"]
    before = shuffles_held(spark)
    table = store_days.write_store_days(fact, f"{schema}.dealt", buckets=4, dealt=True)
    # Neither the write nor what it read leaves a shuffle behind.
    assert shuffles_held(spark) == before
    assert all(len(files) <= len(STORES) for files in files_of(spark.table(table)).values())
    want = star.fact_store_day(known, *sides, month_close=True)
    got = spark.table(table).select(*want.columns)
    assert rows(got, "store_key", "date_key") == rows(want, "store_key", "date_key")
    assert all(".zstd." in f for f in spark.table(table).inputFiles())


def test_a_correction_leaves_no_shuffle_of_its_writes(spark, schema, sides):
    known = every(5)
    table = f"{schema}.tidy"
    store_days.write_store_days(star.fact_store_day(sales_of(spark, listed(known)), *sides), table, buckets=2)
    day = next(d for d, s in known if s == 1 and d // 100 == 202306)
    known[day, 1] = 12345
    sales = sales_of(spark, listed(known))
    changed = sales.where((F.col("date_key") == day) & (F.col("store_key") == 1))
    kept = []
    insert = type(sales.write).insertInto

    def counted(self, *args, **more):
        held = shuffles_held(spark)
        insert(self, *args, **more)
        kept.append(shuffles_held(spark) - held)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(sales.write), "insertInto", counted)
        store_days.correct_store_days(spark, table, changed, sales, *sides)
    assert kept == [0]
    want = star.fact_store_day(sales, *sides)
    assert rows(spark.table(table).select(*want.columns), "store_key", "date_key") == rows(want, "store_key", "date_key")
