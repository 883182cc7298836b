"""Data-quality checks evaluated in one pass per table.

A suite is a list of checks. All of them, and the verdict over them, come out of
a single aggregate of the table, so a suite of five checks costs one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 0.05

# The public names of the check kinds and of the verdict row.
NOT_NULL = "expect_column_values_to_not_be_null"
CONTAINS = "expect_column_distinct_values_to_contain_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTHS = "expect_column_value_lengths_to_be_between"
ROW_COUNT = "expect_row_count_to_be_between"
SUM = "expect_column_sum_to_be_between"
UNIQUE_COUNT = "expect_column_unique_value_count_to_be_between"
OVERALL = "overall"

RESULT_COLUMNS = ("expectation_type", "column", "passed", "observed", "detail")


@dataclass(frozen=True)
class Outcome:
    """Expressions over the aggregated row: verdict, short text, JSON detail."""

    passed: Column
    observed: Column
    detail: Column


@dataclass(frozen=True)
class Check:
    """What to aggregate and how to judge the aggregates."""

    kind: str
    column: str
    aggregates: Callable[[], dict[str, Column]] = field(repr=False)
    judge: Callable[[Callable[[str], Column]], Outcome] = field(repr=False)


def _within(value: Column, low, high) -> Column:
    """Inclusive bounds; an absent bound or an absent value does not fail."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high))
    return F.coalesce(ok, F.lit(True))


def _json(**parts: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))


def _bounds(low, high, kind: str) -> dict[str, Column]:
    named = {"min_value": low, "max_value": high}
    return {k: F.lit(v).cast(kind) for k, v in named.items() if v is not None}


def not_null(column: str) -> Check:
    def judge(agg):
        nulls, rows = agg("nulls"), agg("rows")
        text = F.concat(nulls.cast("string"), F.lit("/"), rows.cast("string"), F.lit(" nulls"))
        return Outcome(nulls == 0, text, _json(null_count=nulls, row_count=rows))

    def counts():
        return {"nulls": F.count_if(F.col(column).isNull()), "rows": F.count(F.lit(1))}

    return Check(NOT_NULL, column, counts, judge)


def row_count(low: int, high: int | None = None) -> Check:
    def judge(agg):
        rows = agg("rows")
        text = F.concat(rows.cast("string"), F.lit(" rows"))
        detail = _json(**_bounds(low, high, "bigint"), observed=rows)
        return Outcome(_within(rows, low, high), text, detail)

    return Check(ROW_COUNT, "", lambda: {"rows": F.count(F.lit(1))}, judge)


def contains(column: str, values: Iterable[str]) -> Check:
    """Every listed value occurs. Only listed values are gathered, so the set on
    the driver and in the buffers is never larger than the list."""
    expected = sorted(values)

    def judge(agg):
        wanted = F.array(*[F.lit(v) for v in expected])
        seen = F.sort_array(agg("seen"))
        missing = F.array_except(wanted, seen)
        quoted = F.transform(missing, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
        text = F.concat(F.lit("missing=["), F.array_join(quoted, ", "), F.lit("]"))
        return Outcome(F.size(missing) == 0, text, _json(expected=wanted, observed=seen))

    def seen():
        listed = F.when(F.col(column).isin(expected), F.col(column))
        return {"seen": F.collect_set(listed)}

    return Check(CONTAINS, column, seen, judge)


def _min_max_check(kind: str, column: str, value, low, high, shown: str) -> Check:
    def aggregates():
        ends = {"high": (high, F.max), "low": (low, F.min)}
        return {k: end(value(column)) for k, (bound, end) in ends.items() if bound is not None}

    def judge(agg):
        parts, ok = {}, F.lit(True)
        if high is not None:
            parts["max_value"] = F.lit(high).cast(shown)
            parts["observed_max"] = agg("high").cast(shown)
            ok = ok & _within(agg("high"), None, high)
        if low is not None:
            parts["min_value"] = F.lit(low).cast(shown)
            parts["observed_min"] = agg("low").cast(shown)
            ok = ok & _within(agg("low"), low, None)
        text = _json(**parts) if parts else F.lit("{}")
        return Outcome(ok, text, text)

    return Check(kind, column, aggregates, judge)


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    """Smallest and largest value lie in the bounds; an empty column passes."""
    return _min_max_check(BETWEEN, column, F.col, low, high, "double")


def lengths_between(column: str, low: int | None = None, high: int | None = None) -> Check:
    return _min_max_check(LENGTHS, column, F.length, low, high, "bigint")


def sum_between(column: str, low: float | None = None, high: float | None = None) -> Check:
    def judge(agg):
        total = F.coalesce(agg("total"), F.lit(0)).cast("double")
        text = F.concat(F.lit("sum="), F.format_number(total, 2))
        detail = _json(sum=total, **_bounds(low, high, "double"))
        return Outcome(_within(total, low, high), text, detail)

    return Check(SUM, column, lambda: {"total": F.sum(column)}, judge)


def unique_count_between(
    column: str, low: int | None = None, high: int | None = None, rsd: float | None = None
) -> Check:
    """Exact distinct count, or an estimate with relative error ``rsd``.

    Each exact count of a suite beyond the first makes Spark pass every row once
    more through the aggregate; estimates do not.
    """

    def judge(agg):
        n = agg("uniques")
        text = F.concat(n.cast("string"), F.lit(" unique values"))
        detail = _json(**_bounds(low, high, "bigint"), observed=n)
        return Outcome(_within(n, low, high), text, detail)

    def uniques():
        exact = rsd is None
        return {
            "uniques": F.count_distinct(F.col(column))
            if exact
            else F.approx_count_distinct(column, rsd)
        }

    return Check(UNIQUE_COUNT, column, uniques, judge)


def evaluate(
    df: DataFrame,
    checks: Sequence[Check],
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """One row per check plus the verdict row; lazy, one aggregate in all.

    The suite passes when failures <= threshold * number of checks.
    """
    aggregates, outcomes = [], []
    for i, check in enumerate(checks):
        for name, agg in check.aggregates().items():
            aggregates.append(agg.alias(f"_{i}_{name}"))
        outcomes.append(check.judge(lambda name, i=i: F.col(f"_{i}_{name}")))
    # A constant keeps a suite without aggregates valid.
    measured = df.agg(F.count(F.lit(1)).alias("_rows"), *aggregates)

    rows = [
        _result(check.kind, check.column, o.passed, o.observed, o.detail)
        for check, o in zip(checks, outcomes, strict=True)
    ]
    failed = F.lit(0)
    for o in outcomes:
        failed = failed + F.when(o.passed, 0).otherwise(1)
    verdict = failed <= F.lit(float(threshold)) * max(len(checks), 1)
    tally = F.concat(failed.cast("string"), F.lit(f"/{len(checks)} failed"))
    rows.append(
        _result(OVERALL, "", verdict, tally, _json(threshold=F.lit(float(threshold))))
    )
    return measured.select(F.inline(F.array(*rows)))


def _result(kind: str, column: str, passed, observed, detail) -> Column:
    values = (F.lit(kind), F.lit(column), passed, observed, detail)
    return F.struct(*[v.alias(n) for v, n in zip(values, RESULT_COLUMNS, strict=True)])


def settled(results: DataFrame) -> DataFrame:
    """Results computed once and held as rows: one row per check, nothing else."""
    return results.sparkSession.createDataFrame(results.collect(), results.schema)


class QualityFailure(ValueError):
    """A suite or a balance did not pass."""


def enforce(results: DataFrame, label: str = "column", text: str = "observed") -> None:
    """Raise when any row failed. ``results`` has one row per check."""
    failed = results.where(~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        raise QualityFailure("; ".join(f"{r[0]}:{r[label]}={r[text]}" for r in failed))


def overall(results: DataFrame) -> DataFrame:
    """AND over all rows of a result, as one row."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def keep_valid(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which the condition is false or NULL."""
    return df.where(F.coalesce(condition, F.lit(False)))


def count_dropped(df: DataFrame, condition: Column) -> DataFrame:
    """Rows kept and dropped by ``keep_valid``, in one aggregate."""
    ok = F.coalesce(condition, F.lit(False))
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the query on a row for which the condition is false or NULL.

    The test is a filter, which stays in the plan whatever columns are read later.
    """
    failed = F.raise_error(F.lit(message)).cast("boolean")
    return df.where(F.when(condition, F.lit(True)).otherwise(failed))
