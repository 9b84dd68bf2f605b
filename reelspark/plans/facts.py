"""Facts, full and incremental.

fct_ratings: one row per (user, film), current rating only.
fct_genome_scores: a rounded view of the relevance matrix.
fct_movie_rating_daily: one row per (film, day with ratings) with trailing
7- and 28-calendar-day measures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import day, day_number, round_half_up, safe_ratio
from ..operators.latest import latest_per_key
from ..operators.upsert import (check_lookback, high_water_mark_filter, lit_of,
                                lookback_bounds, max_value, merge_upsert)

RATING_COLS = ("user_id", "movie_id", "rating", "rating_timestamp")
RATING_KEYS = ("user_id", "movie_id")
DAILY_KEYS = ("movie_id", "rating_date")

# --- fixed values: the reference's window and lookback lengths --------------
SHORT_WINDOW_DAYS = 7
LONG_WINDOW_DAYS = 28
REPROCESS_DAYS = 28
READ_DAYS = 56
# ---------------------------------------------------------------------------


# ---------------------------------------------------------------- fct_ratings

def latest_ratings(stg_ratings: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the latest event per (user, film), ordered by time then by the
    ``tiebreak`` columns (which must make the order total within a key)."""
    order = ["rating_timestamp", *tiebreak]
    return latest_per_key(stg_ratings, RATING_KEYS, order, ["rating"]).select(*RATING_COLS)


def fct_ratings_full(stg_ratings: DataFrame, dedupe: bool = False,
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """M9 first build. Like the reference, no de-duplication unless asked."""
    if dedupe:
        return latest_ratings(stg_ratings, tiebreak)
    return stg_ratings.select(*RATING_COLS)


def fct_ratings_incremental(target: DataFrame | None, stg_ratings: DataFrame,
                            lookback: dt.timedelta | None = None, dedupe: bool = False,
                            tiebreak: Sequence[str] = ()) -> DataFrame:
    """M9 incremental: rows at or after the target's high-water mark, merged on
    (user, film). An absent or empty target is a first run (I4)."""
    mark = max_value(target, "rating_timestamp") if target is not None else None
    if mark is None:
        return fct_ratings_full(stg_ratings, dedupe, tiebreak)
    batch = high_water_mark_filter(stg_ratings, "rating_timestamp", mark, lookback)
    batch = latest_ratings(batch, tiebreak) if dedupe else batch.select(*RATING_COLS)
    # a de-duplicated batch is grouped by the merge keys: unique by construction
    return merge_upsert(target.select(*RATING_COLS), batch, RATING_KEYS,
                        check_duplicates=not dedupe)


# ---------------------------------------------------------- fct_genome_scores

def fct_genome_scores(stg_genome_scores: DataFrame) -> DataFrame:
    """Rounded relevance, deliberately unfiltered."""
    return stg_genome_scores.select(
        "movie_id", "tag_id", round_half_up("relevance", 4).alias("relevance_score"))


# ------------------------------------------------------ fct_movie_rating_daily

def daily_ratings(ratings: DataFrame) -> DataFrame:
    """A10: (film, day) -> count and exact sum of ratings.

    Partial aggregation runs before the shuffle on (film, day): a film with a
    huge share of ratings is spread over its days, and collapsed map-side.
    """
    return (ratings.groupBy("movie_id", day("rating_timestamp").alias("rating_date"))
            .agg(F.count(F.lit(1)).alias("n_ratings"),
                 F.sum("rating").alias("sum_rating")))


def rolling_daily(daily: DataFrame, short_days: int = SHORT_WINDOW_DAYS,
                  long_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """W1-W3 on a (film, day) table: RANGE frames over the day number, so a
    frame means calendar days, not rated days. All frames share one window
    node and one sort. The weighted mean is SUM(sum)/SUM(n): the same value as
    SUM(n*avg)/SUM(n), exact for half-star ratings.

    A window partition is one film's days, bounded by the calendar, not by
    the number of ratings.
    """
    w = Window.partitionBy("movie_id").orderBy("_day")
    w_short = w.rangeBetween(-(short_days - 1), 0)
    w_long = w.rangeBetween(-(long_days - 1), 0)
    return (daily.withColumn("_day", day_number("rating_date"))
            .select("movie_id", "rating_date", "n_ratings",
                    round_half_up(safe_ratio("sum_rating", "n_ratings"), 4).alias("avg_rating"),
                    F.sum("n_ratings").over(w_short).alias("n_ratings_7d"),
                    F.sum("n_ratings").over(w_long).alias("n_ratings_28d"),
                    round_half_up(safe_ratio(F.sum("sum_rating").over(w_long),
                                             F.sum("n_ratings").over(w_long)), 4)
                    .alias("avg_rating_28d")))


def movie_rating_daily(ratings: DataFrame, short_days: int = SHORT_WINDOW_DAYS,
                       long_days: int = LONG_WINDOW_DAYS) -> DataFrame:
    """M11 full refresh."""
    return rolling_daily(daily_ratings(ratings), short_days, long_days)


def movie_rating_daily_incremental(
        target: DataFrame | None, ratings: DataFrame,
        reprocess_days: int = REPROCESS_DAYS, read_days: int = READ_DAYS,
        short_days: int = SHORT_WINDOW_DAYS, long_days: int = LONG_WINDOW_DAYS,
        delete_window: bool = False) -> DataFrame:
    """M11 incremental with a bounded lookback.

    m = last day in the target *before* this run; ratings from m - read_days
    are read, days from m - reprocess_days are emitted and merged on
    (film, day). ``delete_window`` also drops target rows inside the emitted
    window first, so a day emptied by a re-rating disappears (I3 fix; the
    reference keeps the stale row).
    """
    check_lookback(read_days, reprocess_days, long_days)
    m = max_value(target, "rating_date") if target is not None else None
    if m is None:                                   # I4: empty target = first run
        return movie_rating_daily(ratings, short_days, long_days)
    read_from, emit_from = lookback_bounds(m, read_days, reprocess_days)
    src = ratings.where(F.col("rating_timestamp") >= lit_of(read_from).cast("timestamp"))
    emitted = (movie_rating_daily(src, short_days, long_days)
               .where(F.col("rating_date") >= lit_of(emit_from)))
    base = target.where(F.col("rating_date") < lit_of(emit_from)) if delete_window else target
    # emitted rows come from a group-by on (film, day): unique by construction
    return merge_upsert(base.select(*emitted.columns), emitted, DAILY_KEYS, check_duplicates=False)
