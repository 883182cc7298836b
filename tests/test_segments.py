import random

import pytest
from pyspark.sql import functions as F

from tillwork.operators import running, segments


def ledger_of(spark, seed=1, entities=6, days=60, hot=400):
    """Rows (item, day, move, base); one item has more than half of all rows."""
    rng, data, want = random.Random(seed), [], {}
    for item in [*range(entities), None]:
        held = base = 3 if item is None else item % 4
        for day in rng.sample(range(1000), hot if item == 0 else rng.randrange(1, days)):
            data.append((item, day, rng.choice([None, *range(-9, 9)]), base))
    for item, day, move, base in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        held = max(0, want.get((item, "last"), base) + (move or 0))
        want[item, day] = want[item, "last"] = held
    schema = "item int, day int, move int, base int"
    return spark.createDataFrame(data, schema), {k: v for k, v in want.items() if k[1] != "last"}


def held(df):
    return {(r.item, r.day): r.held for r in df.collect()}


@pytest.mark.parametrize("length", [1, 7, 100, 5000])
def test_segments_of_any_length_agree_with_a_loop(spark, length):
    df, want = ledger_of(spark, length)
    got = segments.balance_in_segments(
        df, ["item"], "day", F.col("move"), F.col("base"), "held", F.floor(F.col("day") / length)
    )
    assert held(got) == want and got.columns == [*df.columns, "held"]


def test_same_as_the_plain_ledger(spark):
    df, _ = ledger_of(spark, 8)
    known = df.where("move is not null")
    plain = running.clamped_balance(known, ["item"], "day", F.col("move"), F.col("base"), "held")
    cut = segments.balance_in_segments(
        known, ["item"], "day", F.col("move"), F.col("base"), "held", F.floor(F.col("day") / 50)
    )
    assert held(cut) == held(plain)


def test_days_added_read_the_state_alone(spark):
    df, want = ledger_of(spark, 5)
    month = F.floor(F.col("day") / 30)
    state = spark.createDataFrame([], "item int, day int, held bigint")
    got = {}
    for low, high in ((0, 400), (400, 401), (401, 1000), (300, 1000)):
        part = df.where(f"day >= {low} and day < {high}")
        rows, state = segments.continued(
            state, part, ["item"], "day", F.col("move"), F.col("base"), "held", month
        )
        # The last part was taken already, and adds nothing.
        assert not set(got) & set(held(rows))
        got |= held(rows)
        state = spark.createDataFrame(state.collect(), state.schema)
    assert got == want


def test_one_entity_is_spread_over_tasks(spark):
    """The rows of a segment, not those of an entity, share a partition of the windows."""
    hot = spark.range(4000).select(F.lit(1).alias("item"), F.col("id").alias("day"), F.lit(1).alias("move"))
    cut = hot.withColumn("_segment", F.floor(F.col("day") / 100))
    rows = segments._prefixes(cut, ["item"], ["day"], F.col("move"))
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 2000
    whole = segments.balance_in_segments(
        hot, ["item"], "day", F.col("move"), F.lit(0), "held", F.floor(F.col("day") / 100)
    )
    assert whole.agg(F.max("held")).first()[0] == 4000
