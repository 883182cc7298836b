"""Typing and tidying expressions for raw text columns.

All casts are ``try_cast``: a malformed value becomes NULL and is caught by the
quality suite instead of failing the whole load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .measures import MONEY

# A rule turns a column name into the cleaned expression of that column.
Rule = Callable[[str], Column]


def typed(sql_type: str) -> Rule:
    return lambda c: F.col(c).try_cast(sql_type)


key = typed("bigint")
integer = typed("int")
money = typed(MONEY)
weight = typed("decimal(10,3)")
day = typed("date")


def text(c: str) -> Column:
    return F.col(c).cast("string")


def code(c: str) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(F.col(c)))


def title(c: str) -> Column:
    """Trimmed with each word capitalised."""
    return F.initcap(F.trim(F.col(c)))


def flag(c: str) -> Column:
    """True for the text or boolean 'true', NULL stays NULL."""
    return F.lower(F.trim(F.col(c).cast("string"))) == "true"


def left_padded(width: int, fill: str = "0") -> Rule:
    """Pads to ``width``; a longer value stays whole, for a length check to name."""

    def padded(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.when(F.length(value) < width, F.lpad(value, width, fill)).otherwise(value)

    return padded


def one_of(allowed: Iterable[str], fallback: str) -> Rule:
    """Values outside the list, and NULL, become ``fallback``."""
    members = list(allowed)
    return lambda c: F.when(F.col(c).isin(members), F.col(c)).otherwise(F.lit(fallback))
