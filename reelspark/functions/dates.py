"""Calendar helpers (session time zone is pinned to UTC by ``session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_any(c, dtype: T.DataType) -> Column:
    """H7: raw event time -> ``timestamp``.

    Epoch seconds (the reference's raw shape) go through ``timestamp_seconds``;
    a ``timestamp_ntz`` column (what Parquet files written without a zone load
    as) is read as UTC wall-clock time.
    """
    col = _col(c)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.timestamp_seconds(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.timestamp_seconds(col.cast("long"))
    if isinstance(dtype, T.StringType):
        return col.try_cast("timestamp")
    return col.cast("timestamp")


def day(c) -> Column:
    """H8: ``ts::DATE`` in the session zone."""
    return F.to_date(_col(c))


def day_number(c) -> Column:
    """Days since 1970-01-01, the numeric key of the RANGE frames."""
    return F.unix_date(_col(c))


def month_start(c) -> Column:
    """H9: ``DATE_TRUNC('month', ts)::DATE``."""
    return F.trunc(F.to_date(_col(c)), "month")


def days_crossed(start, end) -> Column:
    """``DATEDIFF('day', start, end)`` = midnights crossed (23:59 -> 00:01 is 1)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def months_crossed(start, end) -> Column:
    """``DATEDIFF('month', start, end)`` = month boundaries crossed.

    Not ``timestampdiff(MONTH)``, which counts whole months elapsed.
    """
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")
