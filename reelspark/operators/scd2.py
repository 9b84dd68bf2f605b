"""SCD Type 2 snapshot with the ``check`` strategy and hard deletes
invalidated.

One run compares the open versions of the history with the current source
extract on the entity key (one full outer join, shuffled on the key):

| case                                          | action                           |
| --------------------------------------------- | -------------------------------- |
| key open and in source, check columns equal   | keep                             |
| key open and in source, any column differs    | close at run_ts, open new version|
| key only in source (new, or reinstated)       | open new version                 |
| key only open (hard delete)                   | close at run_ts, no successor    |
| closed versions                               | pass through untouched           |

Comparison is NULL-safe (``<=>``): NULL -> value is a change, NULL -> NULL is
not. One ``run_ts`` stamps the whole run; it is an argument, never the clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .upsert import assert_unique_keys, lit_of, max_value

VALID_FROM, VALID_TO, SCD_ID = "valid_from", "valid_to", "scd_id"


class SnapshotOrderError(ValueError):
    """run_ts does not come after every existing version start."""


def version_id(key: str, valid_from: str = VALID_FROM):
    """Deterministic version id: md5 of key and start instant (microseconds)."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"),
                             F.unix_micros(F.col(valid_from)).cast("string")))


def _open_version(src: DataFrame, key: str, cols: Sequence[str], run_ts) -> DataFrame:
    return (src.select(key, *cols)
            .withColumn(VALID_FROM, lit_of(run_ts))
            .withColumn(VALID_TO, F.lit(None).cast("timestamp"))
            .withColumn(SCD_ID, version_id(key))
            .select(key, *cols, SCD_ID, VALID_FROM, VALID_TO))


def snapshot(history: DataFrame | None, source: DataFrame, key: str,
             check_cols: Sequence[str], run_ts: dt.datetime,
             invalidate_hard_deletes: bool = True, validate: bool = True,
             last_valid_from: dt.datetime | None = None) -> DataFrame:
    """One snapshot run; returns the whole new history.

    ``validate`` raises on duplicate source keys and on a ``run_ts`` that is
    not after every existing ``valid_from`` (two small aggregate jobs; the
    second is skipped when the caller passes the known ``last_valid_from``).
    """
    cols = list(check_cols)
    src = source.select(key, *cols)
    if validate:
        assert_unique_keys(src, [key])
    if history is None:
        return _open_version(src, key, cols, run_ts)
    if validate:
        last = last_valid_from if last_valid_from is not None else max_value(history, VALID_FROM)
        if last is not None and not run_ts > last:
            raise SnapshotOrderError(f"run_ts {run_ts} is not after last valid_from {last}")

    closed = history.where(F.col(VALID_TO).isNotNull()).select(key, *cols, SCD_ID, VALID_FROM, VALID_TO)
    rows = changes(history.where(F.col(VALID_TO).isNull()), src, key, cols, run_ts, invalidate_hard_deletes)
    return closed.unionByName(rows)


def changes(open_: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], run_ts: dt.datetime,
            invalidate_hard_deletes: bool = True) -> DataFrame:
    """What a run makes of the open versions: those that stay open, the new ones, and those it closes. Versions that
    were closed before are not looked at."""
    cols = list(check_cols)
    out_cols = [key, *cols, SCD_ID, VALID_FROM, VALID_TO]
    src = source.select(key, *cols)
    o = open_.select(F.col(key), *[F.col(c).alias(f"_o_{c}") for c in cols],
                     F.col(SCD_ID).alias("_o_id"), F.col(VALID_FROM).alias("_o_from"))
    s = src.select(F.col(key), *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s"))
    j = o.join(s, key, "full_outer")

    in_o, in_s = F.col("_o_id").isNotNull(), F.col("_s").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"_o_{c}").eqNullSafe(F.col(f"_s_{c}")) for c in cols], F.lit(True))
    changed = in_o & in_s & ~same
    run = lit_of(run_ts)
    close_old = changed | (in_o & ~in_s) if invalidate_hard_deletes else changed

    old_version = F.when(in_o, F.struct(
        *[F.col(f"_o_{c}").alias(c) for c in cols],
        F.col("_o_id").alias(SCD_ID), F.col("_o_from").alias(VALID_FROM),
        F.when(close_old, run).otherwise(F.lit(None).cast("timestamp")).alias(VALID_TO)))
    new_version = F.when(in_s & (~in_o | changed), F.struct(
        *[F.col(f"_s_{c}").alias(c) for c in cols],
        F.lit(None).cast("string").alias(SCD_ID), run.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO)))

    rows = (j.select(key, F.explode(F.array(old_version, new_version)).alias("_v"))
            .where(F.col("_v").isNotNull())
            .select(key, "_v.*"))
    return rows.withColumn(SCD_ID, F.coalesce(F.col(SCD_ID), version_id(key))).select(*out_cols)


def run_sequence(extracts: Sequence[tuple[dt.datetime, DataFrame]], key: str,
                 check_cols: Sequence[str], store_every: int = 0) -> DataFrame:
    """Apply ``snapshot`` over ordered (run_ts, extract) pairs.

    With ``store_every`` > 0 the history is written as a table in the shared
    checkpoint folder every that many runs (as a scheduled snapshot stores
    it), so a long sequence neither re-plans nor recomputes from the first
    extract.
    """
    from ..session import materialize
    # the keys of all extracts are validated at once, the run times here
    runs = [ext.select(F.lit(i).alias("_run"), key) for i, (_, ext) in enumerate(extracts, 1)]
    assert_unique_keys(reduce(DataFrame.unionByName, runs), ["_run", key])
    history, last = None, None
    for i, (ts, ext) in enumerate(extracts, 1):
        if last is not None and not ts > last:
            raise SnapshotOrderError(f"run_ts {ts} is not after last valid_from {last}")
        history = snapshot(history, ext, key, check_cols, ts, validate=False)
        last = ts
        if store_every and i % store_every == 0:
            history = materialize(history)
    return history
