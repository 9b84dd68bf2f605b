"""S16 + Q10: source freshness from load metadata, not event time.

The age of a source is ``now - max(file modification time)`` of its files
(read from the file listing, one row for each file).
Thresholds are per source; a source with no thresholds is 'disabled'.
``now`` is an argument, so a run is reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import lit_of

# --- fixed values: the reference's thresholds (monthly load cadence) ---------
WARN_AFTER_DAYS = 35
ERROR_AFTER_DAYS = 60
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Freshness:
    path: str
    warn_after_days: int | None = WARN_AFTER_DAYS
    error_after_days: int | None = ERROR_AFTER_DAYS
    fmt: str = "parquet"

    @property
    def disabled(self) -> bool:
        return self.warn_after_days is None and self.error_after_days is None


class StaleSourceError(RuntimeError):
    pass


def _status(age_days, warn, error):
    age = F.col(age_days)
    # thresholds and nothing loaded: the source is not fresh
    st = F.when(age.isNull(), F.lit("error"))
    st = st.when(F.lit(error).isNotNull() & (age > F.lit(error)), F.lit("error"))
    st = st.when(F.lit(warn).isNotNull() & (age > F.lit(warn)), F.lit("warn"))
    return st.otherwise(F.lit("pass"))


def last_loaded(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: the newest file modification time under ``path``."""
    # one row for each file; the content column is not read
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*.{fmt}").load(path))
    return files.select(F.max("modificationTime").alias("last_loaded_at"))


def load_status(loads: DataFrame, now: dt.datetime, warn_after_days: int | None = WARN_AFTER_DAYS,
                error_after_days: int | None = ERROR_AFTER_DAYS) -> DataFrame:
    """(source, last_loaded_at, age_days, status) of sources whose last load is known; a NULL one never was loaded."""
    age = (F.unix_micros(lit_of(now)) - F.unix_micros("last_loaded_at")) / 86_400e6
    return loads.select("source", "last_loaded_at", age.alias("age_days")).withColumn("status", _status("age_days", warn_after_days, error_after_days))


def source_freshness(spark: SparkSession, sources: Mapping[str, Freshness],
                     now: dt.datetime) -> DataFrame:
    """(source, last_loaded_at, age_days, warn_after_days, error_after_days, status)."""
    parts = []
    for name, s in sources.items():
        if s.disabled:
            parts.append(spark.range(1).select(
                F.lit(name).alias("source"), F.lit(None).cast("timestamp").alias("last_loaded_at"),
                F.lit(None).cast("double").alias("age_days"),
                F.lit(None).cast("int").alias("warn_after_days"),
                F.lit(None).cast("int").alias("error_after_days"),
                F.lit("disabled").alias("status")))
            continue
        loads = last_loaded(spark, s.path, s.fmt).select(F.lit(name).alias("source"), "last_loaded_at")
        parts.append(load_status(loads, now, s.warn_after_days, s.error_after_days).select(
            "source", "last_loaded_at", "age_days", F.lit(s.warn_after_days).cast("int").alias("warn_after_days"),
            F.lit(s.error_after_days).cast("int").alias("error_after_days"), "status"))
    return reduce(DataFrame.unionByName, parts)


def freshness_gate(report: DataFrame) -> list[dict]:
    """Q10: 'error' blocks the run, 'warn' passes (returned for logging)."""
    rows = [r.asDict() for r in report.where(F.col("status").isin("warn", "error")).collect()]
    errors = [r for r in rows if r["status"] == "error"]
    if errors:
        raise StaleSourceError(", ".join(
            f"{r['source']} is empty" if r["age_days"] is None else f"{r['source']} is {r['age_days']:.1f} days old"
            for r in errors))
    return rows
