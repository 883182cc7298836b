import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.operators.upsert import merged, upsert_partitions, upsert_table
from tillwork.session import fresh_dir


def kv(spark, *data, schema="k int, v string"):
    return spark.createDataFrame(list(data), schema)


def test_insert_update_keep(spark, schema):
    table = f"{schema}.t"
    upsert_table(spark, kv(spark, (1, "a"), (2, "b")), table, ["k"])
    for _ in range(2):  # a repeated batch changes nothing
        upsert_table(spark, kv(spark, (2, "c"), (3, "d")), table, ["k"])
        assert rows(spark.table(table).select("k", "v")) == [(1, "a"), (2, "c"), (3, "d")]
    assert spark.table(table).columns == ["k", "v", "sil_updated_ts"]


def test_null_key_matches_null_key(spark, schema):
    table = f"{schema}.t"
    upsert_table(spark, kv(spark, (None, "a"), (1, "b")), table, ["k"])
    upsert_table(spark, kv(spark, (None, "z")), table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(None, "z"), (1, "b")]


def test_copies_in_the_batch_and_new_columns(spark, schema):
    table = f"{schema}.t"
    upsert_table(spark, kv(spark, (1, "a"), (2, "b")), table, ["k"])
    wide = kv(spark, (2, "y", 5), (2, "x", 6), schema="k int, v string, w int")
    upsert_table(spark, wide, table, ["k"])
    assert rows(spark.table(table).select("k", "v", "w")) == [(1, "a", None), (2, "x", 6)]


def test_failed_batch_leaves_the_table(spark, schema):
    table = f"{schema}.t"
    upsert_table(spark, kv(spark, (1, "a")), table, ["k"])
    broken = kv(spark, (2, "b")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        upsert_table(spark, broken, table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(1, "a")]


def test_small_batch_does_not_shuffle_the_target(spark):
    path = fresh_dir(spark, "target")
    spark.range(100_000).selectExpr("id k", "id v").write.parquet(path)
    target = spark.read.parquet(path)
    got = merged(target, target.limit(5), ["k"])
    assert "BroadcastHashJoin" in plan(got) and "LeftAnti" in plan(got)


def test_only_touched_partitions_are_rewritten(spark):
    root = fresh_dir(spark, "parts")
    base = kv(spark, (1, 10, "a"), (2, 10, "b"), (3, 10, "c"), (None, 11, "n"),
              schema="day int, k int, v string")
    base.withColumn("sil_updated_ts", F.current_timestamp()).write.partitionBy("day").parquet(root)
    files = {f for f in spark.read.parquet(root).inputFiles() if "day=1/" in f}
    batch = kv(spark, (2, 10, "B"), (2, 20, "x"), (4, 10, "d"), (None, 11, "N"),
               schema="day int, k int, v string")
    for _ in range(2):
        upsert_partitions(spark, batch, root, ["day", "k"], "day")
        got = rows(spark.read.parquet(root).select("day", "k", "v"))
        assert got == [
            (None, 11, "N"), (1, 10, "a"), (2, 10, "B"), (2, 20, "x"), (3, 10, "c"), (4, 10, "d"),
        ]
    assert files == {f for f in spark.read.parquet(root).inputFiles() if "day=1/" in f}
    with pytest.raises(ValueError):
        upsert_partitions(spark, batch, root, ["k"], "day")
