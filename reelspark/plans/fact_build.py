"""The one merge of the incremental facts, for the build, the streams and the two-run queries.

Both facts are stored by month, so that the lookback of the daily fact reads the last months of the ratings only. The
ratings are bucketed by (user, film) within a month as well: finding the rows that a batch replaces is a join on the
bucketing columns, which does not shuffle the published side, and only the months that hold one are written anew.

A merge reads its batch once, stages the months it changes, and returns them as a candidate. Nothing is visible before
``publish``: an audit in between that fails leaves the served rows, and their high-water mark, as they were, so the next
run meets the same batch again. ``publish`` replaces the months, then commits the mark: after a crash between the two,
the next run replaces the same rows again. Only a table without a commit is a first run; a read error is an error.

The film history is stored by the run that closed a version, the open versions together: a run writes the open versions
anew and the ones it closes, and never reads or rewrites those that earlier runs have closed.

Row checks and the new mark are counted while the staged rows are written (``Watch``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_start
from ..operators import scd2
from ..operators.checks import Watch
from ..operators.upsert import assert_same_schema, assert_unique_keys, lit_of, lookback_bounds
from ..session import materialize, remove
from ..sources.tables import FactTable, touched_values
from . import facts

MONTH = "rating_month"
BUCKET = "user_bucket"
CLOSED_BY = "closed_by"


class BucketCountError(ValueError):
    """The stored number of buckets is not the asked one: keys would be in two places."""


def ratings_table(table: Callable[..., FactTable], *where) -> FactTable:
    """The ratings at a place (``FactTable.at`` or ``FactTable`` with what they ask for)."""
    return table(*where, MONTH, facts.RATING_KEYS)


def daily_table(table: Callable[..., FactTable], *where) -> FactTable:
    return table(*where, MONTH)


def _in(column: str, values: list) -> Column:
    """Whether a partition is one of ``values`` (None is the partition of nulls)."""
    known = [v for v in values if v is not None]
    return F.when(F.col(column).isNull(), F.lit(None in values)).otherwise(F.col(column).isin(known) if known else F.lit(False))


@dataclass
class Candidate:
    """A merge that is staged and not yet published."""

    table: FactTable
    keys: Sequence[str]
    rows: DataFrame
    """What was written: a whole version, or whole partitions."""
    version: str | None = None
    path: str | None = None
    touched: list = field(default_factory=list)
    emptied: list = field(default_factory=list)
    moving: bool = False
    buckets: int = 0
    props: dict = field(default_factory=dict)
    watch: Watch | None = None

    def _others(self) -> DataFrame:
        """The published rows of the partitions that stay."""
        return self.table.read().where(~_in(self.table.column, self.touched))

    def whole(self) -> DataFrame:
        """The table as it will be."""
        return self.rows if self.version else self._others().unionByName(self.rows)

    def changed(self) -> DataFrame:
        """All rows of the partitions that this run wrote to."""
        return self.rows

    def related(self) -> DataFrame:
        """The rows of the table as it will be that share a key with a changed row: what a broken key would show in,
        as the published rows were unique. Only where a key can be in two partitions are others read."""
        if self.version or not self.moving:
            return self.rows
        keys = list(self.keys)
        return self._others().join(self.rows.select(*keys), keys, "left_semi").select(*self.rows.columns).unionByName(self.rows)

    def publish(self) -> None:
        if self.version:
            self.table.commit(self.version, self.props)
            return
        self.table.replace(self.rows, self.emptied, self.buckets)
        self.table.commit_props(self.props)
        remove(self.rows.sparkSession, self.path)

    def discard(self) -> None:
        """Removes what was staged and will not be published."""
        if self.version:
            self.table.discard(self.version)
        else:
            remove(self.rows.sparkSession, self.path)


def first(table: FactTable, rows: DataFrame, keys: Sequence[str], buckets: int = 0, watch: Watch | None = None) -> Candidate:
    """A whole new table."""
    watch = watch or Watch([])
    version = table.stage_whole(rows, buckets, watch.on)
    return Candidate(table, keys, table.read(version), version=version, buckets=buckets, watch=watch)


def _staged(table: FactTable, rows: DataFrame, touched: list, keys: Sequence[str], watch: Watch | None, **more) -> Candidate:
    watch = watch or Watch([])
    # the partitions written, at most as many as the table has
    watch.also("_values", F.collect_set(table.column))
    watch.also("_nulls", F.count_if(F.col(table.column).isNull()))
    path = table.stage_parts(rows, watch.on)
    staged = table.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    found = set(watch.value("_values") or []) | ({None} if watch.value("_nulls") else set())
    return Candidate(table, keys, staged, path=path, touched=sorted({*touched, *found}, key=str), emptied=[v for v in touched if v not in found], watch=watch, **more)


def upsert(table: FactTable, batch: DataFrame, keys: Sequence[str], moving: bool = False, buckets: int = 0,
           newer: str | None = None, watch: Watch | None = None) -> Candidate:
    """Merges ``batch`` (with the partition column, keys unique): its partitions are written anew and, if a key can
    move between partitions (``moving``), those that hold one of its keys now. Where ``newer`` is given, a batch row
    that is older by it than the published row of its key is left out."""
    keys, column = list(keys), table.column
    target = table.read()
    assert_same_schema(target, batch)
    batch = materialize(batch.select(*target.columns))
    assert_unique_keys(batch, keys)
    met = None
    if moving or newer:
        # The published rows the batch meets, at most one per batch row. The join is on the bucketing columns, so the
        # published side is read where it lies.
        met = materialize(target.select(*keys, column, *([newer] if newer else [])).join(batch.select(*keys), keys, "left_semi"))
    if newer:
        late = met.withColumnRenamed(newer, "_held").drop(column).join(batch, keys).where(F.col("_held") > F.col(newer)).select(*keys)
        batch = materialize(batch.join(late, keys, "left_anti").select(*target.columns))
        met = met.join(batch.select(*keys), keys, "left_semi")
    touched = set(touched_values(batch, column)) | (set(touched_values(met, column)) if moving else set())
    old = target.where(_in(column, list(touched)))
    rows = old.join(batch.select(*keys), keys, "left_anti").select(*target.columns).unionByName(batch)
    return _staged(table, rows, sorted(touched, key=str), keys, watch, moving=moving, buckets=buckets)


def stored_mark(table: FactTable) -> int | None:
    """The newest event of the published ratings in microseconds since 1970 (UTC)."""
    return table.props().get("mark_us")


def merge_ratings(table: FactTable, batch: DataFrame, buckets: int, full_refresh: bool = False,
                  newer: str | None = None, watch: Watch | None = None) -> Candidate:
    """fct_ratings with ``batch`` merged on (user, film); ``batch`` holds the rows at or after the stored mark."""
    props = table.props()
    new = full_refresh or not table.exists()
    if not new and props["buckets"] != buckets:
        raise BucketCountError(f"{table.root} has {props['buckets']} buckets, not {buckets}: refresh it in full")
    watch = watch or Watch([])
    watch.also("newest", F.max(F.unix_micros("rating_timestamp")))
    rows = batch.select(*facts.RATING_COLS).withColumn(MONTH, month_start("rating_timestamp"))
    out = first(table, rows, facts.RATING_KEYS, buckets, watch) if new else upsert(table, rows, facts.RATING_KEYS, True, buckets, newer, watch)
    before = None if new else props.get("mark_us")
    out.props = {"buckets": buckets, "mark_us": max((m for m in (watch.value("newest"), before) if m is not None), default=None)}
    return out


def recent(ratings: DataFrame, day: dt.date) -> DataFrame:
    """The ratings from a day on; where they are stored by month, only its partitions are read."""
    out = ratings.where(F.col("rating_timestamp") >= lit_of(day).cast("timestamp"))
    return out.where(F.col(MONTH) >= lit_of(day.replace(day=1))) if MONTH in ratings.columns else out


def merge_daily(table: FactTable, ratings: DataFrame, full_refresh: bool = False, whole_months: bool = False, watch: Watch | None = None) -> Candidate:
    """fct_movie_rating_daily from ``ratings``: days within the lookback of the stored last day are computed anew.

    ``whole_months`` replaces the touched months instead of merging into them, so that days which a re-rating has
    emptied go.
    """
    props = table.props()
    watch = watch or Watch([])
    watch.also("newest", F.max("rating_date"))
    by_month = lambda df: df.withColumn(MONTH, month_start("rating_date"))
    if full_refresh or not table.exists() or props.get("last_day") is None:
        out = first(table, by_month(facts.movie_rating_daily(ratings)), facts.DAILY_KEYS, watch=watch)
    else:
        read_from, emit_from = lookback_bounds(dt.date.fromisoformat(props["last_day"]), facts.READ_DAYS, facts.REPROCESS_DAYS)
        if whole_months:
            emit_from = emit_from.replace(day=1)
            read_from = emit_from - dt.timedelta(days=facts.LONG_WINDOW_DAYS - 1)
        emitted = by_month(facts.movie_rating_daily(recent(ratings, read_from)).where(F.col("rating_date") >= lit_of(emit_from)))
        if whole_months:
            held = touched_values(table.read().where(F.col(MONTH) >= lit_of(emit_from)), MONTH)
            out = _staged(table, emitted, held, facts.DAILY_KEYS, watch)
        else:
            out = upsert(table, emitted, facts.DAILY_KEYS, watch=watch)
    newest = watch.value("newest")
    out.props = {"last_day": max((d for d in (newest and newest.isoformat(), props.get("last_day")) if d), default=None)}
    return out


def history_table(table: Callable[..., FactTable], *where) -> FactTable:
    return table(*where, CLOSED_BY)


def merge_history(table: FactTable, source: DataFrame, key: str, check_cols: Sequence[str], run_ts: dt.datetime,
                  watch: Watch | None = None) -> Candidate:
    """One snapshot run (S13-S15) of ``source`` into the stored history."""
    assert_unique_keys(source, [key])
    run = run_ts.isoformat()
    by_run = lambda df: df.withColumn(CLOSED_BY, F.when(F.col(scd2.VALID_TO).isNotNull(), F.lit(run)))
    if not table.exists():
        out = first(table, by_run(scd2.snapshot(None, source, key, check_cols, run_ts, validate=False)), [key], watch=watch)
    else:
        last = table.props()["run_ts"]
        if not run_ts > dt.datetime.fromisoformat(last):
            raise scd2.SnapshotOrderError(f"run_ts {run_ts} is not after the last run, {last}")
        open_versions = table.read().where(F.col(CLOSED_BY).isNull())
        rows = by_run(scd2.changes(open_versions, source, key, check_cols, run_ts)).select(*open_versions.columns)
        out = _staged(table, rows, [None], [key], watch, moving=True)
    out.props = {"run_ts": run}
    return out
