"""Retention from stored state that each load adds to, without reading older ratings again.

Two states, both keyed by month and stored as one Parquet folder per month:

* the bridge (X2, exact): for each activity month the users as bitmaps, 32,768 user ids to a row of 4 KB. A load makes
  the bitmaps of its own ratings (combined in the map tasks, so a user with a third of the ratings is a bit) and ORs
  them into the months it touches. Retention ANDs the months with the cohorts' own bitmaps. It suits dense integer ids.
* the sketches (X1, approximate): for each cohort and activity month a HyperLogLog sketch of the users, of a fixed
  size whatever the number of users. A load unions its own sketches in.

OR and union are idempotent: a load that is replayed after a failure changes nothing. A sketch can't forget a user, so
where a late rating moves a user to an earlier cohort, the cohorts concerned are sketched anew (``moved_cohorts``); the
bridge knows no cohorts and needs nothing. Ratings without a user or a time count nowhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_start, months_crossed, round_half_up, safe_ratio
from ..session import exists, materialize
from ..sources.tables import replace_partitions, touched_values

BRIDGE = "bucket long, bitmap binary, activity_month date"
SKETCHES = "cohort_month date, sketch binary, activity_month date"
MONTH = "activity_month"
RSD = 0.02


def held(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored state; one that no load has written to is empty."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def add(load: DataFrame, path: str, schema: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merges a load into the months it touches and replaces those months; the others are not read. The load's own
    bitmaps or sketches are stored first, so that its ratings are read once."""
    load = materialize(load)
    months = touched_values(load, MONTH)
    state = held(load.sparkSession, path, schema)
    touched = state.where(F.col(MONTH).isin(months)) if months else state.where("false")
    replace_partitions(merge(touched.unionByName(load.select(*state.columns))).select(*state.columns), path, MONTH)


# ------------------------------------------------------------- X2: the bridge

def bridge_load(ratings: DataFrame) -> DataFrame:
    """The users of each month of ``ratings`` as bitmaps."""
    user = F.col("user_id").cast("long")
    return (ratings.where(user.isNotNull() & F.col("rating_timestamp").isNotNull())
            .groupBy(month_start("rating_timestamp").alias(MONTH), F.bitmap_bucket_number(user).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("bitmap")))


def merge_bridge(rows: DataFrame) -> DataFrame:
    return rows.groupBy(MONTH, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def add_to_bridge(ratings: DataFrame, path: str) -> None:
    add(bridge_load(ratings), path, BRIDGE, merge_bridge)


def active_users(bridge: DataFrame) -> DataFrame:
    """(activity_month, active_users), exact."""
    return bridge.groupBy(MONTH).agg(F.sum(F.bitmap_count("bitmap")).alias("active_users"))


def _members(dim_users: DataFrame) -> DataFrame:
    return dim_users.where(F.col("first_rating_at").isNotNull() & F.col("user_id").isNotNull()).select(F.col("user_id").cast("long").alias("user_id"), "cohort_month")


def retention_from_bridge(dim_users: DataFrame, bridge: DataFrame) -> DataFrame:
    """M14 from the bridge: the same relation as ``marts.mart_user_cohort_retention``.

    A (cohort, month) pair of a bucket is one AND of two bitmaps, so the join grows with users / 32,768 and the
    square of the months, not with ratings.
    """
    members = _members(dim_users)
    cohorts = members.groupBy("cohort_month", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("members"))
    pairs = cohorts.join(bridge, "bucket").where(F.col(MONTH) >= F.col("cohort_month"))
    both = (pairs.select("cohort_month", MONTH, "bucket", F.explode(F.array("members", "bitmap")).alias("bits"))
            .groupBy("cohort_month", MONTH, "bucket").agg(F.bitmap_and_agg("bits").alias("bits")))
    active = (both.groupBy("cohort_month", MONTH).agg(F.sum(F.bitmap_count("bits")).alias("active_users"))
              .where(F.col("active_users") > 0))
    return _rates(active, members)


# ------------------------------------------------------------ X1: the sketches

def sketch_size(rsd: float) -> int:
    """The sketch's size (log2 of its registers) whose relative standard deviation, 1.04 / sqrt(2^size), is at most ``rsd``."""
    size = math.ceil(2 * math.log2(1.04 / rsd))
    if not 4 <= size <= 21:
        raise ValueError(f"no sketch has a relative standard deviation of {rsd}")
    return size


def sketch_load(dim_users: DataFrame, ratings: DataFrame, rsd: float = RSD) -> DataFrame:
    """The users of each (cohort, month) of ``ratings`` as sketches; they are filled in the map tasks of the join."""
    rows = ratings.select(F.col("user_id").cast("long").alias("user_id"), month_start("rating_timestamp").alias(MONTH))
    return (rows.join(_members(dim_users), "user_id").groupBy("cohort_month", MONTH)
            .agg(F.hll_sketch_agg("user_id", sketch_size(rsd)).alias("sketch")))


def merge_sketches(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cohort_month", MONTH).agg(F.hll_union_agg("sketch").alias("sketch"))


def add_to_sketches(dim_users: DataFrame, ratings: DataFrame, path: str, rsd: float = RSD) -> None:
    add(sketch_load(dim_users, ratings, rsd), path, SKETCHES, merge_sketches)


def moved_cohorts(before: DataFrame, after: DataFrame) -> list:
    """The cohorts that users left or entered between two states of the user dimension (at most one per month)."""
    old = _members(before).select("user_id", F.col("cohort_month").alias("_old"))
    moved = old.join(_members(after), "user_id").where(F.col("_old") != F.col("cohort_month"))
    return [r[0] for r in moved.select(F.explode(F.array("_old", "cohort_month")).alias("m")).distinct().collect()]


def sketch_again(dim_users: DataFrame, ratings: DataFrame, path: str, cohorts: Sequence, rsd: float = RSD) -> None:
    """Replaces the sketches of some cohorts by those of all their users' ratings."""
    state = held(ratings.sparkSession, path, SKETCHES)
    others = state.where(~F.col("cohort_month").isin(list(cohorts)))
    own = sketch_load(dim_users.where(F.col("cohort_month").isin(list(cohorts))), ratings, rsd)
    replace_partitions(others.unionByName(own.select(*state.columns)), path, MONTH)


def retention_from_sketches(dim_users: DataFrame, sketches: DataFrame) -> DataFrame:
    """M14 from the sketches: ``active_users`` within their error, ``cohort_size`` exact (a count of the dimension)."""
    active = sketches.select("cohort_month", MONTH, F.hll_sketch_estimate("sketch").alias("active_users"))
    return _rates(active, _members(dim_users))


def _rates(active: DataFrame, members: DataFrame) -> DataFrame:
    sizes = members.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (active.join(sizes, "cohort_month")
            .select("cohort_month", "cohort_size", months_crossed("cohort_month", MONTH).alias("months_since_first_rating"),
                    F.col("active_users").cast("long").alias("active_users"),
                    round_half_up(F.least(safe_ratio("active_users", "cohort_size"), F.lit(1.0)), 4).alias("retention_rate")))
