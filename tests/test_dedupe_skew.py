from helpers import plan
from pyspark.sql import functions as F

from tillwork.operators.dedupe import keep_first, keep_last


def test_hot_key_is_limited_before_the_shuffle(spark):
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    first, last = keep_first(df, ["k"]), keep_last(df, ["k"])
    before_shuffle = plan(first).split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert first.count() == last.count() == n - n // 3 + 1
    assert first.where("k = -1").first().v == 0
    assert last.where("k = -1").first().v == n - 3
