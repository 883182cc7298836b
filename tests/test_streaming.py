import pytest
from helpers import rows

from tillwork.operators import deltas
from tillwork.operators.deltas import DeltaTable
from tillwork.session import fresh_dir
from tillwork.streaming import evolution, intake


def drop(tmp_path, name, text):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text(text)


def test_each_file_once_and_wider_schema(spark, schema, tmp_path):
    table, state = f"{schema}.events", fresh_dir(spark, "state")
    source = str(tmp_path / "in")

    def drain(columns):
        stream = intake.file_stream(spark, source, columns, "events", max_files=1)
        intake.drain_to_table(stream, table, state)
        return spark.table(table).count()

    drop(tmp_path, "1.csv", "id,v\n1,a\n2,b\n")
    assert drain("id int, v string") == 2
    assert drain("id int, v string") == 2
    drop(tmp_path, "2.csv", "id,v\n3,c\n")
    assert drain("id int, v string") == 3
    assert {r._load_id for r in spark.table(table).collect()} == {"stream:events"}
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (w int)")
    drop(tmp_path, "3.csv", "id,v,w\n4,d,7\n")
    assert drain("id int, v string, w int") == 4
    assert rows(spark.table(table).where("id > 2").select("id", "v", "w")) == [
        (3, "c", None), (4, "d", 7),
    ]


def test_upsert_stream_with_cleaner(spark, schema, tmp_path):
    table, state = f"{schema}.kv", fresh_dir(spark, "state")
    source = str(tmp_path / "in")

    def clean(df):
        return df.select("id", "v").where("id is not null").dropDuplicates(["id"])

    for name, text in (("1.csv", "id,v\n1,a\n2,b\n,x\n"), ("2.csv", "id,v\n2,c\n3,d\n")):
        drop(tmp_path, name, text)
        stream = intake.file_stream(spark, source, "id int, v string", "kv")
        intake.drain_to_upsert(stream, table, ["id"], state, clean)
    assert rows(spark.table(table).select("id", "v")) == [(1, "a"), (2, "c"), (3, "d")]


def test_files_that_grow(spark, schema, tmp_path):
    table, state, log = f"{schema}.wide", fresh_dir(spark, "state"), fresh_dir(spark, "log")
    source = str(tmp_path / "in")

    def drain():
        return evolution.drain_evolving(spark, source, "id int, v string", table, state, log)

    drop(tmp_path, "1.csv", "id,v\n1,a\n")
    assert drain() == ["id", "v"]
    drop(tmp_path, "2.csv", 'id,v,"w", x\n2,b,7,y\n')
    assert drain() == ["id", "v", "w", "x"]
    # A file of the old width, and no new file at all, change nothing.
    drop(tmp_path, "3.csv", "id,v\n3,c\n")
    assert drain() == drain() == ["id", "v", "w", "x"]
    assert rows(spark.table(table).select("id", "v", "w", "x")) == [
        (1, "a", None, None), (2, "b", "7", "y"), (3, "c", None, None),
    ]
    assert evolution.new_headers(spark, source, log).isEmpty()
    drop(tmp_path, "4.csv", "v,id\nd,4\n")
    with pytest.raises(evolution.ColumnsMoved, match="4.csv"):
        drain()
    assert spark.table(table).count() == 3


def test_headers_alone_are_logged_when_a_run_stops(spark, schema, tmp_path, monkeypatch):
    table, state, log = f"{schema}.stop", fresh_dir(spark, "state"), fresh_dir(spark, "log")
    drop(tmp_path, "1.csv", "id,v,w\n1,a,2\n")

    def stopped(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(evolution, "drain_to_table", stopped)
    with pytest.raises(RuntimeError):
        evolution.drain_evolving(spark, str(tmp_path / "in"), "id int, v string", table, state, log)
    monkeypatch.undo()
    columns = evolution.drain_evolving(spark, str(tmp_path / "in"), "id int, v string", table, state, log)
    assert columns == ["id", "v", "w"] and rows(spark.table(table).select("id", "w")) == [(1, "2")]


def test_rollup_over_drains(spark, schema, tmp_path):
    table, state = f"{schema}.sums", fresh_dir(spark, "state")

    def drain():
        stream = intake.file_stream(spark, str(tmp_path / "in"), "k string, n int", "n")
        intake.drain_rollup(stream, ["k"], ["n"], table, state)
        return rows(spark.table(table))

    drop(tmp_path, "1.csv", "k,n\na,1\nb,2\na,3\n,5\n")
    assert drain() == [(None, 5), ("a", 4), ("b", 2)]
    drop(tmp_path, "2.csv", "k,n\nb,10\nc,1\n,1\n")
    assert drain() == [(None, 6), ("a", 4), ("b", 12), ("c", 1)]
    held = DeltaTable(spark, table)
    # The second drain wrote the three groups that it changed.
    assert spark.table(held.deltas).count() == 3
    assert drain() == [(None, 6), ("a", 4), ("b", 12), ("c", 1)]


def test_totals_of_a_rollup_are_written_without_a_dedupe(spark, schema, tmp_path, monkeypatch):
    """A micro-batch brings one row for each group."""
    asked = []
    kept = deltas._newest
    monkeypatch.setattr(deltas, "_newest", lambda *a: asked.append(1) or kept(*a))
    table, state = f"{schema}.totals", fresh_dir(spark, "state")
    for name, text in (("1.csv", "k,n\na,1\n,2\n"), ("2.csv", "k,n\na,3\n,4\n")):
        drop(tmp_path, name, text)
        stream = intake.file_stream(spark, str(tmp_path / "in"), "k string, n int", "n")
        intake.drain_rollup(stream, ["k"], ["n"], table, state)
    assert rows(spark.table(table)) == [(None, 6), ("a", 4)]
    assert asked == []


def test_late_delivery_in_a_later_drain(spark, schema, tmp_path):
    for kind in ("upsert", "deltas"):
        table, state, place = f"{schema}.late_{kind}", fresh_dir(spark, "state"), tmp_path / kind
        place.mkdir()

        def drain(name, text):
            drop(place, name, text)
            stream = intake.file_stream(spark, str(place / "in"), "id int, v string, at int", "late")
            if kind == "upsert":
                intake.drain_to_upsert(stream, table, ["id"], state, versions=["at"])
            else:
                intake.drain_to_deltas(stream, table, ["id"], state, ["at"], compact_after=2)
            return rows(spark.table(table).select("id", "v"))

        assert drain("1.csv", "id,v,at\n1,new,5\n2,b,5\n") == [(1, "new"), (2, "b")]
        assert drain("2.csv", "id,v,at\n1,old,3\n2,c,6\n3,d,1\n") == [(1, "new"), (2, "c"), (3, "d")]
        assert drain("3.csv", "id,v,at\n1,same,5\n3,older,0\n") == [(1, "same"), (2, "c"), (3, "d")]
