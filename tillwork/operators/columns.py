"""Bulk column work: casts, projections, cutoffs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import Rule
from ..functions.measures import MONEY
from ..functions.retail_calendar import date_key

LINEAGE_COLUMNS = ("_ingestion_ts", "_load_id", "_source_file", "_arrived")
UPDATE_STAMP = "sil_updated_ts"


def cast_columns(df: DataFrame, columns: Iterable[str], sql_type: str) -> DataFrame:
    """One projection for all casts; values that do not fit become NULL."""
    return df.withColumns({c: F.col(c).try_cast(sql_type) for c in columns})


def cast_money(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return cast_columns(df, columns, MONEY)


def cast_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return cast_columns(df, columns, "bigint")


def apply_rules(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Rewrite each named column by its rule; the others pass through."""
    return df.withColumns({c: rule(c) for c, rule in rules.items()})


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE_COLUMNS)


def keys_first(df: DataFrame, keys: Sequence[str], stamp: Column | None = None) -> DataFrame:
    """Keys, then the payload without lineage, then the update time."""
    rest = [c for c in drop_lineage(df).columns if c not in {*keys, UPDATE_STAMP}]
    now = F.current_timestamp() if stamp is None else stamp
    return df.select(*keys, *rest, now.alias(UPDATE_STAMP))


def up_to(df: DataFrame, as_of: str | None, key: str = "date_key") -> DataFrame:
    """Rows up to a day given as YYYY-MM-DD; the bound reaches the scan."""
    if as_of is None:
        return df
    return df.where(F.col(key) <= date_key(F.lit(as_of).cast("date")))


def at_latest(df: DataFrame, key: str = "date_key") -> DataFrame:
    """Rows of the newest partition: an uncorrelated scalar subquery on the key."""
    newest = df.select(F.max(key).alias("newest"))
    return df.where(F.col(key) == newest.scalar())
