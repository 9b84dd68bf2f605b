"""Incremental maintenance without MERGE.

Plain Parquet has no MERGE/UPDATE/DELETE. A merge upsert is
``target LEFT ANTI JOIN source ON keys  UNION ALL  source``: matched target
rows are replaced whole, unmatched source rows are inserted, nothing is
deleted. NULL keys never match (plain equality), exactly as in MERGE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChangeError(ValueError):
    """An increment's columns differ from the target's (policy 'fail')."""


class DuplicateKeyError(ValueError):
    """The upsert source holds a key more than once (MERGE would raise)."""


def schema_signature(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def assert_same_schema(target: DataFrame, source: DataFrame) -> None:
    """Names and types must agree (order may differ)."""
    t, s = schema_signature(target), schema_signature(source)
    if t != s:
        extra = sorted(set(s) - set(t))
        missing = sorted(set(t) - set(s))
        retyped = sorted(k for k in set(t) & set(s) if t[k] != s[k])
        raise SchemaChangeError(
            f"schema change: extra={extra} missing={missing} retyped={retyped}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (NULL keys included, like MERGE)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise on duplicate source keys; never silently pick one."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"upsert source has duplicate keys {list(keys)}: {dup[0].asDict()}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 check_schema: bool = True, check_duplicates: bool = True) -> DataFrame:
    """Replace matched rows whole, insert unmatched, never delete."""
    keys = list(keys)
    if check_schema:
        assert_same_schema(target, source)
    if check_duplicates:
        assert_unique_keys(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert source rows whose key is absent from the target."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def max_value(df: DataFrame, col: str):
    """One global MAX, returned to the driver as a literal (an
    instant as a naive UTC datetime, whatever zone the driver is in)."""
    if isinstance(df.schema[col].dataType, T.TimestampType):
        us = df.agg(F.max(F.unix_micros(col)).alias("m")).first()["m"]
        return None if us is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    return df.agg(F.max(col).alias("m")).first()["m"]


def lit_of(value) -> Column:
    """A literal; a naive datetime is UTC."""
    if isinstance(value, dt.datetime):
        return F.lit(value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)).cast("timestamp")
    if isinstance(value, dt.date):
        return F.lit(value).cast("date")
    return F.lit(value)


def high_water_mark_filter(source: DataFrame, col: str, mark,
                           lookback: dt.timedelta | None = None) -> DataFrame:
    """Inclusive ``col >= mark`` (rows sharing the boundary instant are
    re-read and then replaced by the merge, not duplicated). ``lookback``
    widens the window for late rows (I1 fix)."""
    if mark is None:
        return source
    if lookback:
        mark = mark - lookback
    return source.where(F.col(col) >= lit_of(mark))


def check_lookback(read_days: int, reprocess_days: int, window_days: int) -> None:
    """The oldest reprocessed day needs ``window_days - 1`` days behind it."""
    if read_days < reprocess_days + window_days - 1:
        raise ValueError(
            f"read_days={read_days} < reprocess_days + window_days - 1 = "
            f"{reprocess_days + window_days - 1}: oldest emitted window would be truncated")


def lookback_bounds(max_day: dt.date, read_days: int, reprocess_days: int) -> tuple[dt.date, dt.date]:
    """S9 + S10: (first day read, first day emitted) relative to the target's last day."""
    return max_day - dt.timedelta(days=read_days), max_day - dt.timedelta(days=reprocess_days)
