"""Incremental runs over the test tables: two runs of each incremental model.

Run 1 sees part of the source, run 2 the whole source. Two ways to split:

* by event time (``rating_timestamp < CUTOFF``): incremental = full refresh
  when (user, film) keys are de-duplicated;
* by arrival (``arrived_at < CUTOFF``, the order date): rows that arrive
  after run 1 but carry an event time below its high-water mark are *late*;
  the default skips them (I1), ``lookback`` loads them.

Each function returns the model after run 2.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import lit_of
from ..session import scratch_path
from ..sources import raw
from ..sources.tables import FactTable
from . import dims, fact_build, facts, retention, staging
from . import inputs as I

# --- fixed values of the two-run scenarios -----------------------------------
CUTOFF = dt.datetime(1998, 6, 1)
LATE_LOOKBACK = dt.timedelta(days=150)   # longer than any ship delay in the data
TAG_CUTOFF = dt.datetime(2024, 1, 15)
# ---------------------------------------------------------------------------

T = I.TIEBREAK


def _new_folder(spark: SparkSession, name: str) -> str:
    import uuid
    return scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame) -> DataFrame:
    """Run 1's output as the next run finds it: written as a table in the
    shared checkpoint folder (``spark.checkpoint.dir``), lineage cut."""
    from ..session import materialize
    return materialize(df)


def _split(df: DataFrame, col: str, cutoff) -> DataFrame:
    return df.where(F.col(col) < lit_of(cutoff))


def ratings_two_runs(spark: SparkSession, d: str, split_col: str = "rating_timestamp",
                     lookback: dt.timedelta | None = None) -> tuple[DataFrame, DataFrame]:
    """(fct_ratings after run 1, after run 2), de-duplicated, merged on (user, film)."""
    r = I.ratings(spark, d)
    run1 = stored(facts.fct_ratings_incremental(None, _split(r, split_col, CUTOFF), dedupe=True,
                                                tiebreak=T))
    run2 = facts.fct_ratings_incremental(run1, r, lookback=lookback, dedupe=True, tiebreak=T)
    return run1, run2


def ratings_incremental(spark, d):
    return ratings_two_runs(spark, d)[1]


def incremental_late_rows(spark, d):
    return ratings_two_runs(spark, d, "arrived_at")[1]


def incremental_late_rows_lookback(spark, d):
    return ratings_two_runs(spark, d, "arrived_at", LATE_LOOKBACK)[1]


def daily_two_runs(spark, d, delete_window: bool = False) -> DataFrame:
    """fct_movie_rating_daily after two runs; re-ratings across the cut-off
    move a (user, film) row to a later day (I3)."""
    f1, f2 = ratings_two_runs(spark, d)
    d1 = stored(facts.movie_rating_daily(f1))
    return facts.movie_rating_daily_incremental(d1, stored(f2), delete_window=delete_window)


def daily_incremental(spark, d):
    return daily_two_runs(spark, d)


def daily_incremental_delete_window(spark, d):
    return daily_two_runs(spark, d, delete_window=True)


def daily_partition_replace(spark, d, path: str | None = None) -> DataFrame:
    """X4 + X5: the daily fact stored partitioned by month; run 2 recomputes
    whole months from the first month the lookback touches and replaces only
    those month partitions. Rewriting whole months also removes days that a
    re-rating emptied (no stale rows inside the rewritten months).
    """
    f1, f2 = ratings_two_runs(spark, d)
    table = fact_build.daily_table(FactTable.at, spark, path or _new_folder(spark, "daily"))
    fact_build.merge_daily(table, f1).publish()
    fact_build.merge_daily(table, stored(f2), whole_months=True).publish()
    return table.read().drop(fact_build.MONTH)


def ratings_bucket_merge(spark, d, path: str | None = None, buckets: int = 4) -> DataFrame:
    """fct_ratings stored by month and, within it, by user bucket; run 2
    finds the rows its batch replaces without a shuffle of the target and
    rewrites only the months that hold one."""
    r = I.ratings(spark, d)
    table = fact_build.ratings_table(FactTable.at, spark, path or _new_folder(spark, "ratings"))
    run1 = facts.fct_ratings_full(_split(r, "rating_timestamp", CUTOFF), dedupe=True, tiebreak=T)
    fact_build.merge_ratings(table, run1, buckets).publish()
    since = F.timestamp_micros(F.lit(fact_build.stored_mark(table)))
    batch = facts.latest_ratings(r.where(F.col("rating_timestamp") >= since), T)
    fact_build.merge_ratings(table, batch, buckets).publish()
    return table.read().drop(fact_build.MONTH)


def users_dim_incremental(spark, d) -> DataFrame:
    """The user dimension from mergeable per-user state.

    Each run aggregates only its new rows to (n, sum, min, max) per user and
    merges with the stored state by re-aggregating the union; the dimension is
    derived from the state. Batches are disjoint (split by arrival), so the
    result equals the full rebuild.
    """
    r, t = I.ratings(spark, d), I.tags(spark, d)

    def rating_state(df):
        return df.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n_ratings"), F.sum("rating").alias("sum_rating"),
            F.min("rating_timestamp").alias("first_rating_at"),
            F.max("rating_timestamp").alias("last_rating_at"))

    def tag_state(df):
        return dims.tag_activity(df)

    def merge_rating(a, b):
        return a.unionByName(b).groupBy("user_id").agg(
            F.sum("n_ratings").alias("n_ratings"), F.sum("sum_rating").alias("sum_rating"),
            F.min("first_rating_at").alias("first_rating_at"),
            F.max("last_rating_at").alias("last_rating_at"))

    def merge_tag(a, b):
        return a.unionByName(b).groupBy("user_id").agg(
            F.sum("n_tags").alias("n_tags"), F.min("first_tag_at").alias("first_tag_at"),
            F.max("last_tag_at").alias("last_tag_at"))

    late = F.col("arrived_at") >= lit_of(CUTOFF)
    # run 1 stores its state, run 2 reads it again
    rs = stored(merge_rating(stored(rating_state(r.where(~late))), rating_state(r.where(late))))
    tlate = F.col("tag_timestamp") >= lit_of(TAG_CUTOFF)
    ts = stored(merge_tag(stored(tag_state(t.where(~tlate))), tag_state(t.where(tlate))))
    activity = rs.select("user_id", "n_ratings",
                         (F.col("sum_rating") / F.col("n_ratings")).alias("avg_rating_given"),
                         "first_rating_at", "last_rating_at")
    return dims.dim_users_from_activity(activity, ts)


def stored_bridge(spark, d) -> DataFrame:
    """The (month, user) bitmaps after two loads, split by arrival: the second one ORs late rows into old months."""
    r, path = I.ratings(spark, d), _new_folder(spark, "bridge")
    late = F.col("arrived_at") >= lit_of(CUTOFF)
    retention.add_to_bridge(r.where(~late), path)
    retention.add_to_bridge(r.where(late), path)
    return retention.held(spark, path, retention.BRIDGE)


def staged_ratings(spark, d, columns: tuple[str, ...] = ("user_id", "rating", "rating_timestamp")) -> DataFrame:
    """The staged ratings as a stored table (an extract is one): the line items meet their orders once, whatever reads them."""
    return stored(I.ratings(spark, d).select(*columns, "arrived_at"))


def sketched_retention(spark, d) -> DataFrame:
    """Retention from the (cohort, month) sketches of two loads, split by arrival. The second load moves users to
    earlier cohorts; these are sketched anew before it is added."""
    r = staged_ratings(spark, d)
    return sketched_loads(spark, d, r, stored(dims.dim_users(r, I.tags(spark, d))))


def sketched_loads(spark, d, r: DataFrame, both: DataFrame) -> DataFrame:
    """``sketched_retention`` of stored ratings and the user dimension after both loads."""
    path = _new_folder(spark, "sketches")
    late = F.col("arrived_at") >= lit_of(CUTOFF)
    first = r.where(~late)
    before = stored(dims.dim_users(first, I.tags(spark, d)))
    retention.add_to_sketches(before, first, path)
    if moved := retention.moved_cohorts(before, both):
        retention.sketch_again(both, first, path, moved)
    retention.add_to_sketches(both, r.where(late), path)
    return retention.retention_from_sketches(both, retention.held(spark, path, retention.SKETCHES))


def text_extract(spark, d) -> raw.Landed:
    """The ratings as a text extract (epoch seconds, columns in another order), landed. Of an order whose key
    ends in 7 the third line's rating is no number, of one whose key ends in 3 the first line's time is a date."""
    r, path = I.ratings(spark, d), _new_folder(spark, "extract")
    rating = F.when((F.col("l_orderkey") % 10 == 7) & (F.col("l_linenumber") == 3), F.lit("n/a")).otherwise(F.col("rating").cast("string"))
    seconds = F.unix_seconds("rating_timestamp").cast("string")
    time = F.when((F.col("l_orderkey") % 10 == 3) & (F.col("l_linenumber") == 1), F.to_date("rating_timestamp").cast("string")).otherwise(seconds)
    (r.select(F.col("movie_id").alias("movieId"), F.col("user_id").alias("userId"), time.alias("timestamp"), rating.alias("rating"))
     .write.option("header", True).csv(path))
    return raw.land(spark, path, raw.RAW_RATINGS, _new_folder(spark, "landed"), max_rejects=0.1)


def ratings_from_text(spark, d) -> DataFrame:
    """The staged ratings of the lines that fit."""
    return staging.stg_ratings(text_extract(spark, d).rows)


def ratings_text_rejects(spark, d) -> DataFrame:
    """The lines that do not, and how often each is there."""
    return text_extract(spark, d).rejects.groupBy("record").agg(F.count(F.lit(1)).alias("n"))
