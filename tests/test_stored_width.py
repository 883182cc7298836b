import gzip

import pytest
from helpers import plan
from pyspark.sql import functions as F

from parity.queries import write_csv
from tillwork.operators.columns import LINEAGE_COLUMNS
from tillwork.operators.upsert import upsert_table
from tillwork.plans import entities, increments
from tillwork.sources import feeds

SALES = entities.DAILY_SALES


def landed(spark, **more):
    """Text rows of the sales feed; two deliveries of one key, the second one later."""
    names = [f.name for f in spark.createDataFrame([], feeds.DAILY_SALES).schema]
    df = spark.range(2).select(*[F.lit("1").alias(c) for c in names if c != "unit_qty"],
                               (F.col("id") + 5).cast("string").alias("unit_qty"))
    stamps = {
        "_ingestion_ts": F.lit("2025-01-01").cast("timestamp"),
        "_load_id": F.lit("bronze:x"),
        "_source_file": F.concat(F.lit("file:/"), F.lit(9) - F.col("id")),
    }
    return spark.range(2).select("id").join(df.withColumn("id", F.col("unit_qty") - 5), "id").withColumns(
        {**stamps, **more}
    ).drop("id")


def test_lineage_that_decides_nothing_is_not_sorted(spark, tmp_path):
    landed(spark).write.parquet(str(tmp_path / "landed"))
    stored = spark.read.parquet(str(tmp_path / "landed"))
    cleaned = SALES.cleaned(stored, order=entities.DELIVERY)
    assert "_source_file" not in plan(cleaned) and "_ingestion_ts" in plan(cleaned)
    assert not set(cleaned.columns) & set(LINEAGE_COLUMNS)
    assert [r.unit_qty for r in cleaned.collect()] == [6]


def test_lineage_that_decides_stays(spark):
    later = landed(spark, _ingestion_ts=F.when(F.col("unit_qty") == 5, F.lit("2025-01-02")).otherwise(
        F.lit("2025-01-01")).cast("timestamp"))
    assert [r.unit_qty for r in SALES.cleaned(later, order=entities.DELIVERY).collect()] == [5]
    # Before the quantity, the file decides: of equal deliveries the last file.
    mixed = landed(spark)
    first = ["_ingestion_ts", "_load_id", "_source_file"]
    mixed = mixed.select(*first, *[c for c in mixed.columns if c not in first])
    assert [r.unit_qty for r in SALES.cleaned(mixed, order=entities.DELIVERY).collect()] == [5]


def test_versions_of_upserts_are_stored_with_zstd(spark, schema):
    for batch in (spark.range(5), spark.range(3, 9)):
        upsert_table(spark, batch, f"{schema}.numbers", ["id"])
        assert all(".zstd." in f for f in spark.table(f"{schema}.numbers").inputFiles())


def test_a_load_lands_without_a_shuffle(spark, schema, tmp_path, monkeypatch):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"k,v\n{k},a\n")
    feed = feeds.Feed("tills", str(tmp_path), "k int, v string", False, True, options=feeds.BY_LINE)

    def refused(self, name, *columns):
        raise AssertionError(name)

    monkeypatch.setattr(type(spark.range(1)), "hint", refused)
    load = increments.land(spark, "", feed, schema)
    table = spark.table(f"{schema}.brz_tills")
    assert sorted(r.k for r in table.where(F.col("_load_id") == load).collect()) == [0, 1, 2]


@pytest.mark.parametrize("rows", [20_000])
def test_feeds_are_packed_fast(spark, tmp_path, rows):
    df = spark.range(0, rows, 1, 1).select("id", (F.col("id") * 7919 % 10007).alias("v"), F.lit("till").alias("t"))
    (file,) = (tmp_path / "x").glob("*.gz") if write_csv(df, str(tmp_path / "x")) else ()
    text, size = gzip.decompress(file.read_bytes()), file.stat().st_size
    assert text.count(b"\n") == rows + 1
    fast, default = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(size - fast) < abs(size - default)
