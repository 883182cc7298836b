import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwork.operators.upsert import table_location, upsert_table
from tillwork.plans import entities, layers
from tillwork.session import shared_root, subfolders
from tillwork.sources import sinks


def days(spark, *data):
    return spark.createDataFrame(data, "k int, v string, day int")


def test_partitioned_target_updates_inserts_and_moves(spark, schema):
    table = f"{schema}.days"
    sinks.replace_table(days(spark, (1, "a", 1), (2, "b", 2), (None, "n", None), (4, "d", 4)), table, ["day"])
    upsert_table(spark, days(spark, (1, "A", 1), (3, "c", 3), (None, "N", None), (4, "D", 1)), table, ["k"])
    want = [(None, "N", None), (1, "A", 1), (2, "b", 2), (3, "c", 3), (4, "D", 1)]
    assert rows(spark.table(table).select("k", "v", "day"), "k") == want
    upsert_table(spark, days(spark, (1, "A", 1), (3, "c", 3), (None, "N", None), (4, "D", 1)), table, ["k"])
    assert rows(spark.table(table).select("k", "v", "day"), "k") == want


def test_untouched_partitions_keep_their_files(spark, schema):
    table = f"{schema}.kept"
    sinks.replace_table(days(spark, (1, "a", 1), (2, "b", 2)), table, ["day"])

    def files(day):
        found = spark.table(table).where(f"day = {day}").select("_metadata.file_name").distinct()
        return {r[0] for r in found.collect()}

    before = files(1), files(2)
    upsert_table(spark, days(spark, (1, "z", 1)), table, ["day", "k"])
    assert files(2) == before[1] and files(1) != before[0]


def test_narrow_batch_keeps_stored_values(spark, schema):
    table = f"{schema}.narrow"
    upsert_table(spark, spark.createDataFrame([(1, "a", 9.5), (2, "b", 1.5)], "k int, v string, w double"), table, ["k"])
    upsert_table(spark, spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string"), table, ["k"])
    assert rows(spark.table(table).select("k", "v", "w")) == [(1, "z", 9.5), (2, "b", 1.5), (3, "c", None)]


def test_changed_type_is_cast_or_refused(spark, schema):
    table = f"{schema}.types"
    upsert_table(spark, spark.createDataFrame([(1, 5)], "k int, v int"), table, ["k"])
    upsert_table(spark, spark.createDataFrame([(1, 7)], "k bigint, v bigint"), table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(1, 7)]
    assert dict(spark.table(table).dtypes)["v"] == "int"
    with pytest.raises(Exception, match="OVERFLOW"):
        upsert_table(spark, spark.createDataFrame([(1, 1 << 40)], "k int, v bigint"), table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(1, 7)]


def test_last_in_order_wins(spark, schema):
    table = f"{schema}.order"
    batch = spark.createDataFrame([(1, 99, 1), (1, 10, 2)], "k int, v int, _ingestion_ts int")
    upsert_table(spark, batch, table, ["k"], order=["_ingestion_ts"])
    assert rows(spark.table(table).select("k", "v")) == [(1, 10)]


def test_no_live_table_in_the_scratch_folder(spark, schema):
    table = f"{schema}.live"
    before = len(subfolders(spark, shared_root(spark)))
    for value in "abc":
        upsert_table(spark, spark.createDataFrame([(1, value)], "k int, v string"), table, ["k"])
    assert "live_versions" in table_location(spark, table)
    assert len(subfolders(spark, shared_root(spark))) == before
    versions = subfolders(spark, table_location(spark, table).rpartition("/")[0])
    assert len(versions) <= 2


def test_recluster_partitioned_table(spark, schema):
    table = f"{schema}.clustered"
    data = spark.range(200).select(
        F.col("id").cast("int").alias("k"), F.lit("x").alias("v"), (F.col("id") % 3).cast("int").alias("day")
    )
    sinks.replace_table(data.repartition(4), table, ["day"])
    old = {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}
    sinks.recluster_table(spark, table, ["k"])
    new = {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}
    assert not old & new
    assert rows(spark.table(table).select("k", "v", "day")) == rows(data)


def test_bad_keys_are_set_apart_and_counted(spark, schema):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), ("y", "c")], "store_key string, name string").withColumns(
        {"open_m2": F.lit("1"), "open_date": F.lit("2020-01-01"), "status": F.lit("Active"), "chain_format": F.lit("hyper")}
    )
    sinks.append_rows(raw, f"{schema}.brz_stores_master")
    names = layers.Layers(schema, schema, schema)
    found = layers.refine(spark, names, [entities.STORE])
    bad = found.where("expectation_type = 'rejected_keys'").collect()
    assert [r.observed for r in bad] == ["2 rows"]
    assert rows(spark.table(f"{schema}.sil_store_rejected").select("store_key", "name")) == [("x", "b"), ("y", "c")]
    assert rows(spark.table(f"{schema}.sil_store").select("store_key", "name")) == [(1, "a")]


def test_older_version_in_a_later_batch_loses(spark, schema):
    for name, parts in (("plain", []), ("parts", ["day"])):
        table = f"{schema}.versions_{name}"
        first = spark.createDataFrame([(1, "new", 5, 1), (2, "b", None, 1)], "k int, v string, at int, day int")
        sinks.replace_table(first, table, parts)
        late = [(1, "old", 4, 1), (2, "B", 1, 2), (3, "c", None, 1), (3, "d", 2, 1)]
        upsert_table(spark, spark.createDataFrame(late, first.schema), table, ["k"], versions=["at"])
        got = rows(spark.table(table).select("k", "v", "at", "day"))
        assert got == [(1, "new", 5, 1), (2, "B", 1, 2), (3, "d", 2, 1)]
        upsert_table(spark, spark.createDataFrame([(1, "same", 5, 1)], first.schema), table, ["k"], versions=["at"])
        assert rows(spark.table(table).where("k = 1").select("v")) == [("same",)]
