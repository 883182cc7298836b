import gzip
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillwork.operators.rollups import row_counts
from tillwork.operators.upsert import table_exists
from tillwork.session import fresh_dir, shared_root
from tillwork.sources import feeds, raw, sinks


def test_paths():
    assert raw.source_path("/data/", "a/b.csv.gz", False) == "/data/a/b.csv.gz"
    assert raw.source_path("/data", "a", True) == "/data/a/*"
    assert raw.source_path("/data", "/x/a", True) == "/x/a/*"
    assert raw.source_path("/data", "s3a://bucket/a", False) == "s3a://bucket/a"


def test_gzip_csv_keeps_text_codes(spark, tmp_path):
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("commerce_period,ean,note\n")
        f.write('2025-06,0001,"two\nlines"\n 2025-07 ,0002,x\n')
    schema = "commerce_period string, ean string, note string"
    got = raw.with_lineage(
        raw.read_raw(spark, str(tmp_path / "b.csv.gz"), "csv", schema), raw.load_id("budget")
    )
    assert rows(got.select("commerce_period", "ean", "note")) == [
        ("2025-06", "0001", "two\nlines"), ("2025-07", "0002", "x"),
    ]
    row = got.first()
    assert row._source_file.endswith("b.csv.gz") and row._load_id.startswith("bronze:budget:2")


def test_json_document_and_override(spark, tmp_path):
    doc = [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    assert rows(raw.read_raw(spark, str(tmp_path / "d.json"), "json", "a int, b string")) == [
        (1, "x"), (2, "y"),
    ]
    (tmp_path / "l.csv").write_text("a;b\n1;q\n")
    got = raw.read_raw(spark, str(tmp_path / "l.csv"), "csv", options={"sep": ";"})
    assert rows(got) == [(1, "q")]


def test_given_and_existing_source(spark):
    df = spark.createDataFrame([("old",), (None,)], "_source_file string")
    got = raw.with_lineage(df, "load", "new")
    assert sorted(r[0] for r in got.select("_source_file").collect()) == ["new", "old"]


def test_snapshot_append_and_counts(spark, schema):
    a, b = f"{schema}.a", f"{schema}.b"
    for _ in range(2):
        sinks.replace_table(spark.range(3), a)
        sinks.append_rows(spark.range(3), b)
    sinks.replace_table(spark.range(4).selectExpr("id", "id % 2 p"), f"{schema}.c", ["p"])
    names = ("a", "b", "c")
    counts = row_counts({n: spark.table(f"{schema}.{n}") for n in names})
    assert rows(counts) == [("a", 3), ("b", 6), ("c", 4)]
    assert table_exists(spark, a) and not table_exists(spark, f"{schema}.none")
    assert sinks.create_schema(spark, schema) == schema  # again is fine


def test_recluster_keeps_content(spark, schema):
    table = f"{schema}.r"
    sinks.replace_table(spark.range(1000).selectExpr("id % 7 a", "id b").repartition(9), table)
    sinks.recluster_table(spark, table, ["a", "b"])
    assert spark.table(table).count() == 1000
    assert spark.table(table).agg({"b": "sum"}).first()[0] == 499_500
    lows = [
        spark.read.parquet(f).agg({"a": "min"}).first()[0]
        for f in spark.table(table).inputFiles()
    ]
    assert lows == sorted(lows) or len(set(lows)) == len(lows)


def test_report(spark):
    data = [("kind", "c", True, "fine", "{}"), ("overall", "", False, "1/2", "{}")]
    df = spark.createDataFrame(
        data, "expectation_type string, column string, passed boolean, observed string, detail string"
    )
    as_json, as_text = sinks.write_report(df, fresh_dir(spark, "rep"), "Title")
    got = json.loads("".join(r.value for r in spark.read.text(as_json).collect()))
    assert got["title"] == "Title" and [r["passed"] for r in got["results"]] == [True, False]
    lines = "\n".join(r.value for r in spark.read.text(as_text).collect())
    assert "| kind:c | PASS | fine |" in lines and "| overall: | FAIL | 1/2 |" in lines


def test_feed_list():
    assert len(feeds.FEEDS) == 8
    assert {f.table for f in feeds.FEEDS if f.snapshot} == {
        "stores_master", "products_master", "calendar_445", "budget",
    }


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Far:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(RuntimeError):
        shared_root(Far)


def test_rows_counted_by_the_write(spark, schema):
    df = spark.createDataFrame([(1,), (2,), (None,), (7,)], "n int")
    seen = sinks.replace_with_valid(df, F.col("n") < 5, f"{schema}.valid")
    assert seen == {"kept": 2, "dropped": 2}
    assert rows(spark.table(f"{schema}.valid")) == [(1,), (2,)]
    assert sinks.replace_with_valid(df.where("false"), F.col("n") < 5, f"{schema}.none") == {"kept": 0, "dropped": 0}
