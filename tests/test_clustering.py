import glob

import pyarrow.parquet as pq
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.operators import clustering
from tillwork.sources import sinks


@pytest.fixture
def grid(spark):
    cell = (F.col("id") * 7919) % 40_000
    return spark.range(40_000).select(
        F.floor(cell / 200).alias("a"), (cell % 200).alias("b"), F.concat(F.lit("v"), F.col("id")).alias("v")
    )


def groups_read(path, column, low, high):
    """Row groups whose statistics do not exclude the range."""
    found = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            found += stats.min <= high and stats.max >= low
    return found


def test_second_column_reads_under_half(grid, tmp_path):
    lexical = sinks.write_clustered(grid, str(tmp_path / "lexical"), ["a", "b"], 64)
    both = clustering.write_zordered(grid, str(tmp_path / "both"), ["a", "b"], 64)
    assert groups_read(both, "b", 50, 55) < groups_read(lexical, "b", 50, 55) / 2
    assert groups_read(both, "a", 50, 55) < 64 / 3
    spark = grid.sparkSession
    assert rows(spark.read.parquet(both)) == rows(grid)


def test_skewed_column_is_cut_by_quantiles(spark, tmp_path):
    skewed = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pow(F.lit(1.001), F.col("id"))).alias("a"),
        ((F.col("id") * 7919) % 1000).alias("b"),
    )
    path = clustering.write_zordered(skewed, str(tmp_path / "z"), ["a", "b"], 32)
    assert groups_read(path, "b", 10, 12) < 16
    assert groups_read(path, "a", 1e6, 1.1e6) < 16


def test_ranks_and_bits(spark):
    df = spark.createDataFrame([(None,), (0.5,), (1.0,), (2.5,), (9.0,)], "x double")
    ranks = df.select(clustering.rank_among(F.col("x"), [1.0, 2.0, 3.0], 2).alias("r"))
    assert [r.r for r in ranks.collect()] == [0, 0, 1, 2, 3]
    key = clustering.interleaved([F.lit(0b10), F.lit(0b11)], 2)
    assert spark.range(1).select(key).first()[0] == 0b1101


def test_kinds_nulls_and_empty_tables(spark, tmp_path):
    df = spark.sql(
        """SELECT id, nullif(id % 5, 0) AS n, concat('é', id) AS s, date_add(date'2024-01-01', int(id)) AS d,
        timestamp_seconds(id) AS t, cast(id AS decimal(18,4)) AS m, id % 2 = 0 AS b FROM range(300)"""
    )
    columns = ["n", "s", "d", "t", "m", "b"]
    path = clustering.write_zordered(df, str(tmp_path / "k"), columns)
    assert rows(spark.read.parquet(path), "id") == rows(df, "id")
    empty = clustering.write_zordered(df.where("false"), str(tmp_path / "e"), columns)
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    with pytest.raises(ValueError):
        clustering.zordered(df, [])


def test_partitioned_table_keeps_its_partitions(spark, schema, grid):
    table = f"{schema}.parts"
    sinks.replace_table(grid.withColumn("p", F.col("a") % 3), table, ["p"])
    want = rows(spark.table(table), "v")
    clustering.zorder_table(spark, table, ["a", "b", "p"])
    assert rows(spark.table(table), "v") == want
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3


def test_one_exchange_behind_the_quantiles(grid):
    text = plan(clustering.zordered(grid, ["a", "b"], 8))
    assert text.count("Exchange rangepartitioning") == 1 and text.count("Exchange ") == 1
