import datetime as dt

import pytest
from helpers import rows

from tillwork.operators.columns import UPDATE_STAMP
from tillwork.plans import entities, increments, layers
from tillwork.sources.feeds import Feed
from tillwork.streaming import runs

SALES = entities.DAILY_SALES
FEED = Feed("sales_daily_store_sku", "sales", "", False, True)
HEAD = "date_key,store_key,product_key,sku,unit_qty,gross_sales,net_sales,discount_amount,tax_amount," \
    "cost_amount,ticket_count,line_count,promo_line_count\n"  # fmt: skip


def line(day, product, qty):
    return f"{day},1,{product},S,{qty},10,9,1,0.5,4,1,1,0\n"


@pytest.fixture
def landing(spark, schema, tmp_path):
    """Lands one file a call; returns the load id."""
    names = layers.Layers(schema, schema, schema)
    from tillwork.sources import feeds

    count = iter(range(100))

    def land(*lines, at=dt.datetime(2025, 1, 1, 10, 0, 0)):
        root = tmp_path / f"load-{next(count)}"
        (root / "sales").mkdir(parents=True)
        (root / "sales" / "day.csv").write_text(HEAD + "".join(lines))
        feed = Feed(FEED.table, "sales", feeds.DAILY_SALES, False, True)
        return increments.land(spark, str(root), feed, schema, at)

    return names, land


def refined(spark, names):
    return rows(spark.table(f"{names.refined}.{SALES.table}").select("date_key", "product_key", "unit_qty"))


def test_only_new_loads_are_read(spark, landing, monkeypatch):
    names, land = landing
    land(line(20250101, 1, 5), line(20250101, 2, 6))
    results = increments.refine_new(spark, names, (SALES,))
    assert {r.table_name for r in results.collect()} == {SALES.table}
    second = land(line(20250101, 2, 60), line(20250102, 1, 7), at=dt.datetime(2025, 1, 2))
    assert increments.new_loads(spark, names, SALES.source) == [second]

    read = []
    cleaned = entities.Entity.cleaned

    def seen(self, landed, **more):
        read.append(rows(landed.select("_load_id").distinct()))
        return cleaned(self, landed, **more)

    monkeypatch.setattr(entities.Entity, "cleaned", seen)
    increments.refine_new(spark, names, (SALES,))
    assert read == [[(second,)]]
    assert refined(spark, names) == [(20250101, 1, 5), (20250101, 2, 60), (20250102, 1, 7)]
    # Nothing new: no landing row is read, and nothing written.
    assert increments.refine_new(spark, names, (SALES,)) is None and len(read) == 1


def test_stop_between_upsert_and_commit(spark, landing, monkeypatch):
    names, land = landing
    land(line(20250101, 1, 5))

    def stopped(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(increments, "commit_loads", stopped)
    with pytest.raises(RuntimeError):
        increments.refine_new(spark, names, (SALES,))
    monkeypatch.undo()
    before = spark.table(f"{names.refined}.{SALES.table}").drop(UPDATE_STAMP)
    held = rows(before)
    assert len(increments.new_loads(spark, names, SALES.source)) == 1
    increments.refine_new(spark, names, (SALES,))
    assert rows(spark.table(f"{names.refined}.{SALES.table}").drop(UPDATE_STAMP)) == held
    assert increments.new_loads(spark, names, SALES.source) == []


def test_loads_of_one_second_stay_apart(spark, landing):
    names, land = landing
    first = land(line(20250101, 1, 5))
    increments.refine_new(spark, names, (SALES,))
    second = land(line(20250101, 1, 8))
    assert second == f"{first}-2" and increments.new_loads(spark, names, SALES.source) == [second]
    increments.refine_new(spark, names, (SALES,))
    assert refined(spark, names) == [(20250101, 1, 8)]


def test_landing_read_is_pruned_to_partitions(spark, landing):
    from helpers import plan

    names, land = landing
    land(line(20250101, 1, 5))
    load = land(line(20250102, 1, 5), at=dt.datetime(2025, 1, 2))
    df = spark.table(f"{names.landing}.{SALES.source}").where(f"_load_id in ('{load}')")
    scan = plan(df)
    assert "PartitionFilters: [isnotnull(_load_id" in scan or "PartitionFilters: [(_load_id" in scan
    assert len(df.select("_metadata.file_path").distinct().collect()) == 1


SNAPSHOT = Feed("shops", "shops.csv", "k int, v string", True, False)
DAILY = Feed("tills", "tills", "k int, v string", False, True)


def test_feeds_of_a_run(spark, schema, tmp_path):
    (tmp_path / "shops.csv").write_text("k,v\n1,a\n")
    (tmp_path / "tills").mkdir()
    (tmp_path / "tills" / "1.csv").write_text("k,v\n1,a\n2,b\n")
    run = lambda: runs.take_feeds(spark, str(tmp_path), schema, str(tmp_path / "state"), (SNAPSHOT, DAILY))
    assert [(t.feed, t.rows) for t in run()] == [("shops", None), ("tills", 2)]
    (tmp_path / "tills" / "2.csv").write_text("k,v\n3,c\n")
    (tmp_path / "shops.csv").write_text("k,v\n1,z\n")
    assert [(t.feed, t.rows) for t in run()] == [("shops", None), ("tills", 1)]
    assert [(t.feed, t.rows) for t in run()] == [("shops", None), ("tills", 0)]
    assert rows(spark.table(f"{schema}.brz_tills").select("k", "v")) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(spark.table(f"{schema}.brz_shops").select("k", "v")) == [(1, "z")]


def test_first_failure_by_name_and_others_end(spark, schema, tmp_path):
    (tmp_path / "tills").mkdir()
    (tmp_path / "tills" / "1.csv").write_text("k,v\n1,a\n")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "1.csv").write_text("k\nx\n")
    strict = Feed("broken", "bad", "k int", False, True, options={"mode": "FAILFAST"})
    missing = Feed("missing", "nowhere.csv", "k int", True, False)
    with pytest.raises(runs.FeedFailure) as failed:
        runs.take_feeds(spark, str(tmp_path), schema, str(tmp_path / "state"), (strict, missing, DAILY))
    assert failed.value.feed == "broken"
    assert rows(spark.table(f"{schema}.brz_tills").select("k", "v")) == [(1, "a")]
    assert not spark.streams.active
