import json

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tillwork.operators import quality as q
from tillwork.operators.balances import Balance, not_negative, reconcile, total
from tillwork.plans import entities


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "a", 1.5), (2, "b", None), (None, None, 3.0)]
    return spark.createDataFrame(data, "k int, s string, x double")


def result(df, check):
    return q.evaluate(df, [check]).collect()[0]


CASES = [
    (q.not_null("k"), False, "1/3 nulls"),
    (q.row_count(1), True, "3 rows"),
    (q.row_count(4), False, "3 rows"),
    (q.row_count(1, 2), False, "3 rows"),
    (q.contains("s", {"a", "b"}), True, "missing=[]"),
    (q.contains("s", {"c", "a", "d"}), False, "missing=['c', 'd']"),
    (q.between("x", 1.5, 3.0), True, None),
    (q.between("x", 1.6), False, None),
    (q.between("x", None, 2.9), False, None),
    (q.between("x"), True, "{}"),
    (q.sum_between("x", 4.5, 4.5), True, "sum=4.50"),
    (q.sum_between("x", 5), False, "sum=4.50"),
    (q.lengths_between("s", 1, 1), True, None),
    (q.lengths_between("s", 2), False, None),
    (q.unique_count_between("s", 2, 2), True, "2 unique values"),
    (q.unique_count_between("s", 3), False, "2 unique values"),
    (q.unique_count_between("s", 1, 3, rsd=0.05), True, "2 unique values"),
]


@pytest.mark.parametrize("check,passed,observed", CASES)
def test_checks(df, check, passed, observed):
    got = result(df, check)
    assert got.passed is passed
    assert observed is None or got.observed == observed
    assert isinstance(json.loads(got.detail), dict)


def test_detail(df):
    assert json.loads(result(df, q.between("x", 0.0, 9.0)).detail) == {
        "max_value": 9.0, "observed_max": 3.0, "min_value": 0.0, "observed_min": 1.5,
    }
    assert json.loads(result(df, q.contains("s", ["b", "z"])).detail) == {
        "expected": ["b", "z"], "observed": ["b"],
    }


def test_empty_table(df):
    none = df.where("k > 9")
    checks = [q.not_null("k"), q.between("x", 0.0), q.sum_between("x", 0, 0), q.row_count(0)]
    assert all(r.passed for r in q.evaluate(none, checks).collect())


def test_verdict_and_threshold(df):
    checks = [q.not_null("k"), q.row_count(1)]
    strict = q.evaluate(df, checks)
    assert rows(strict.where("expectation_type = 'overall'").select("passed", "observed")) == [
        (False, "1/2 failed")
    ]
    assert q.evaluate(df, checks, threshold=0.5).collect()[-1].passed
    with pytest.raises(q.QualityFailure, match="k=1/3 nulls"):
        q.enforce(strict)
    q.enforce(q.evaluate(df, [q.row_count(1)]))
    assert rows(q.overall(strict)) == [(False, 3, 2)]


def test_one_scan_per_suite(spark, tmp_path):
    spark.range(10).selectExpr("id date_key", "id store_key", "id product_key", "id net_sales").write.parquet(
        str(tmp_path / "t")
    )
    got = entities.DAILY_SALES.checked(spark.read.parquet(str(tmp_path / "t")))
    assert plan(got).count("FileScan") == 1 and got.count() == 6


def test_all_suites_hold_33_checks():
    assert [len(e.checks) for e in entities.ENTITIES] == [3, 4, 4, 5, 4, 4, 5, 4]


def test_row_gates(df):
    valid = F.col("x") > 1
    assert q.keep_valid(df, valid).count() == 2
    assert rows(q.count_dropped(df, valid)) == [(2, 1)]
    assert q.require(df.where("x > 1"), valid, "bad").count() == 2
    with pytest.raises(Exception, match="bad row"):
        q.require(df, valid, "bad row").collect()
    with pytest.raises(Exception, match="bad row"):
        q.require(df, valid, "bad row").select(F.lit(1)).collect()


@pytest.mark.parametrize(
    "expected,actual,tolerance,passed,diff",
    [(1000, 1001, 0.05, True, 0.1), (1000, 2000, 0.05, False, 100.0), (0, 0, 0.01, True, 0.0)],
)
def test_balances(spark, expected, actual, tolerance, passed, diff):
    one = spark.range(1)
    totals = total(one, "want", F.lit(expected)).unionByName(total(one, "have", F.lit(actual)))
    got = reconcile(totals, [Balance("net", "want", "have", tolerance)]).collect()[0]
    assert (got.passed, got.diff_pct) == (passed, diff)


def test_budget_sanity(spark):
    one = spark.range(1)
    for amount, ok in ((5, True), (0, True), (-1, False)):
        got = not_negative(total(one, "budget", F.lit(amount)), "sane", "budget").collect()
        assert [r.passed for r in got] == [ok]
