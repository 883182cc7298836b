"""What delivering and loading the feeds leaves and moves."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from helpers import plan, rows, shuffles_held
from pyspark.sql import functions as F

from parity import queries, roles
from tillwork.operators import rollups
from tillwork.session import DROP_SHUFFLES, shuffles_dropped, subfolders
from tillwork.sources import feeds
from tillwork.streaming import runs

LINES = """txn_id string, txn_date date, store_key bigint, product_key bigint, sku string, unit_qty int,
    gross_amount decimal(18,4), net_amount decimal(18,4), discount_amount decimal(18,4),
    tax_amount decimal(18,4), cost_amount decimal(18,4), is_promo boolean, return_flag string"""


@pytest.fixture
def till(spark, monkeypatch):
    """Lines with doubles, returns, missing keys, and articles of which one comes twice."""
    money = [Decimal(x) for x in ("12.3400", "11.1000", "1.2400", "1.7700", "7.4000")]
    data = [
        (t, None if d is None else dt.date(1996, 1, d), s, p, f"SKU-{p}", q, *money, True, f)
        for t, d, s, p, q, f in [
            ("a", 1, 1, 1, 3, "N"), ("a", 1, 1, 1, 3, "N"), ("a", 1, 1, 2, 1, "R"), ("b", 1, 1, 1, 2, "A"),
            ("c", 2, 1, 1, 5, "N"), ("c", 2, 2, 3, 9, "R"), (None, 3, 2, 3, 4, "N"), ("d", 3, None, 2, 1, "N"),
            ("e", 4, 2, None, 1, "N"), ("f", None, 2, 1, None, None), ("g", 40 - 9, 2, 2, 2, "N"),
        ]
    ]
    lines = spark.createDataFrame(data, LINES)
    products = spark.createDataFrame(
        [(1, "A", 2.0, 3.0), (2, "B", 4.0, 5.0), (2, "B", 4.0, 5.0), (3, "A", 1.0, 2.0)],
        "product_key bigint, dept string, unit_cost double, retail_price double",
    ).selectExpr("product_key", "dept", "cast(unit_cost as decimal(18,4)) unit_cost",
                 "cast(retail_price as decimal(18,4)) retail_price")
    monkeypatch.setattr(roles, "lines", lambda s, d: lines)
    monkeypatch.setattr(roles, "products", lambda s, d: products)
    monkeypatch.setattr(roles, "sale_days", lambda s, d: lines.select("txn_date"))
    return lines


@pytest.fixture
def large_tables(spark):
    """Joins as between tables that are too large for a broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    yield
    spark.conf.unset(name)


def moves_of(df, key):
    """Exchanges by columns of which one is ``key``."""
    return sum(key in by for by in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df)))


def test_lines_of_the_inventory_move_once(spark, till, large_tables):
    df = roles.inventory(spark, "")
    assert moves_of(df, "product_key") == 2  # lines and articles
    moved = roles.flows(spark, "")
    assert rows(roles.flows(spark, "", ("product_key",))) == rows(moved) and moved.count() == 9


def test_lines_of_the_budget_move_by_article_once(spark, till, large_tables):
    assert moves_of(roles.budget(spark, ""), "product_key") == 2  # lines and articles


def test_dealt_tickets_move_once(spark, till):
    plain, dealt = rollups.store_day_tickets(till), rollups.store_day_tickets(till, dealt=True)
    assert rows(dealt) == rows(plain) and dealt.dtypes == plain.dtypes
    assert (moves_of(plain, "store_key"), moves_of(dealt, "store_key")) == (2, 1)


def test_dealt_lines_have_the_same_daily_sales(spark, till):
    plain, dealt = roles.daily_sales(spark, ""), roles.dealt_daily_sales(spark, "")
    assert rows(dealt) == rows(plain) and dealt.dtypes == plain.dtypes
    assert moves_of(dealt, "store_key") == 1


def test_loaded_feeds_leave_no_files(spark, monkeypatch):
    few = {t: (lambda s, d, t=t: s.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in
               s.createDataFrame([], next(x.schema for x in feeds.FEEDS if x.table == t)).schema])) for t in
           queries.FEED_ROLES}
    monkeypatch.setattr(queries, "FEED_ROLES", few)
    roots = []
    fresh = queries.fresh_dir

    def noted(session, label):
        path = fresh(session, label)
        if label == "feeds":
            roots.append(path)
        return path

    monkeypatch.setattr(queries, "fresh_dir", noted)
    names = queries.load_layers(spark, "", "tidy")
    for feed in feeds.FEEDS:
        want = 6 if feed.table == "sales_daily_store_sku" else 3
        assert spark.table(f"{names.landing}.brz_{feed.table}").count() == want
    (root,) = roots
    assert not [f for at in subfolders(spark, root) for f in left(spark, at)]


def left(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    out = []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return out


def test_shuffles_of_writes_are_dropped(spark, tmp_path):
    before, mode = shuffles_held(spark), spark.conf.get(DROP_SHUFFLES, None)
    with shuffles_dropped(spark):
        spark.range(100).repartition(3, "id").write.parquet(str(tmp_path / "x"))
    assert shuffles_held(spark) <= before and spark.conf.get(DROP_SHUFFLES, None) == mode
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        1 / 0  # noqa: B018
    assert spark.conf.get(DROP_SHUFFLES, None) == mode


def test_streams_of_a_run_store_zstd(spark, schema, tmp_path):
    (tmp_path / "tills").mkdir()
    (tmp_path / "tills" / "1.csv").write_text("k,v\n1,a\n2,b\n")
    daily = feeds.Feed("packed", "tills", "k int, v string", False, True)
    runs.take_feeds(spark, str(tmp_path), schema, str(tmp_path / "state"), (daily,))
    table = spark.table(f"{schema}.brz_packed")
    assert table.count() == 2 and all(".zstd." in f for f in table.inputFiles())
