import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.operators import deltas
from tillwork.operators.deltas import DeltaTable
from tillwork.operators.upsert import table_location


def frame(spark, *data, columns="k int, v string, at int"):
    return spark.createDataFrame(list(data), columns)


def test_newest_of_base_and_batches(spark, schema):
    table = DeltaTable.create(frame(spark, (1, "a", 1), (2, "b", 1), (None, "n", 1)), f"{schema}.t", ["k"], buckets=4)
    table.take(frame(spark, (2, "B", 2), (3, "c", 2), (None, "N", 2)))
    table.take(frame(spark, (3, "C", 3)))
    want = [(None, "N", 2), (1, "a", 1), (2, "B", 2), (3, "C", 3)]
    assert rows(spark.table(f"{schema}.t")) == want
    table.compact()
    assert rows(table.read()) == want
    table.take(frame(spark, (1, "z", 4)))
    assert rows(table.read()) == [(None, "N", 2), (1, "z", 4), (2, "B", 2), (3, "C", 3)]


def test_older_delivery_taken_later_loses(spark, schema):
    table = DeltaTable.create(frame(spark, (1, "new", 5), (2, "x", None)), f"{schema}.v", ["k"], ["at"], 4)
    table.take(frame(spark, (1, "old", 3), (2, "y", 1), (4, "d", 7)))
    table.take(frame(spark, (4, "older", 6), (2, "none", None)))
    want = [(1, "new", 5), (2, "y", 1), (4, "d", 7)]
    assert rows(table.read()) == want
    table.compact()
    table.take(frame(spark, (1, "old", 4), (4, "same", 7)))
    assert rows(table.read()) == [(1, "new", 5), (2, "y", 1), (4, "same", 7)]


def test_batch_taken_again_changes_nothing(spark, schema):
    table = DeltaTable.create(frame(spark, (1, "a", 1)), f"{schema}.again", ["k"], ["at"], 4)
    batch = frame(spark, (1, "b", 2), (1, "b", 2), (2, "c", 2))
    for _ in range(2):
        table.take(batch)
        assert rows(table.read()) == [(1, "b", 2), (2, "c", 2)]


def test_narrow_and_wider_batches(spark, schema):
    table = DeltaTable.create(frame(spark, (1, "a", 1), (2, "b", 1)), f"{schema}.w", ["k"], buckets=4)
    table.take(frame(spark, (1, 9), (3, 9), columns="k int, at int"))
    assert rows(table.read()) == [(1, "a", 9), (2, "b", 1), (3, None, 9)]
    table.take(frame(spark, (2, "B", 2, 0.5), columns="k int, v string, at int, w double"))
    want = [(1, "a", 9, None), (2, "B", 2, 0.5), (3, None, 9, None)]
    assert rows(spark.table(f"{schema}.w"), "k") == want
    table.compact()
    assert rows(table.read(), "k") == want


def bytes_of(spark, table):
    folder = table_location(spark, table).removeprefix("file:")
    return sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet"))


def test_batch_writes_bytes_of_its_own_size(spark, schema):
    base = spark.range(50_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = DeltaTable.create(base, f"{schema}.big", ["k"], buckets=4)
    whole = bytes_of(spark, table.base)
    before = spark.table(table.base).select("_metadata.file_name").distinct().collect()
    table.take(base.where("k < 100").withColumn("v", F.lit("changed")))
    assert bytes_of(spark, table.deltas) < whole / 100
    assert spark.table(table.base).select("_metadata.file_name").distinct().collect() == before
    assert table.read().where("v = 'changed'").count() == 100 and table.read().count() == 50_000


def test_base_is_read_without_a_shuffle(spark, schema):
    table = DeltaTable.create(spark.range(1000).withColumnRenamed("id", "k"), f"{schema}.plan", ["k"], buckets=4)
    table.take(spark.range(10).withColumnRenamed("id", "k"))
    text = plan(table.read())
    # One exchange for the deltas, none for the base, whose buckets are fewer than shuffles are wide.
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


def test_failed_compaction_leaves_the_table(spark, schema, monkeypatch):
    table = DeltaTable.create(frame(spark, (1, "a", 1)), f"{schema}.fail", ["k"], buckets=4)
    table.take(frame(spark, (1, "b", 2)))

    def broken(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(deltas, "_point", broken)
    with pytest.raises(RuntimeError):
        table.compact()
    monkeypatch.undo()
    assert rows(spark.table(f"{schema}.fail")) == [(1, "b", 2)]
    DeltaTable(spark, f"{schema}.fail").compact()
    assert rows(spark.table(f"{schema}.fail")) == [(1, "b", 2)]


def test_other_tables_are_refused(spark, schema):
    frame(spark, (1, "a", 1)).write.saveAsTable(f"{schema}.plain")
    with pytest.raises(ValueError):
        DeltaTable(spark, f"{schema}.plain")
