"""M6-M8: conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (clean_title, days_crossed, month_start,
                         parse_trailing_year, split_genres, title_case)
from ..functions.text import NO_GENRES


def dim_movies(stg_movies: DataFrame) -> DataFrame:
    """M6: one row per film, title parsed once.

    ``is_unclassified`` is a plain equality, so a NULL genre list gives a NULL
    flag (caught by the not_null check) rather than a guess.
    """
    return stg_movies.select(
        "movie_id",
        clean_title("title").alias("movie_title"),
        parse_trailing_year("title").alias("release_year"),
        F.col("title").alias("source_title"),
        split_genres("genres").alias("genre_array"),
        F.col("genres").alias("genre_list"),
        (F.col("genres") == F.lit(NO_GENRES)).alias("is_unclassified"),
    )


def rating_activity(stg_ratings: DataFrame) -> DataFrame:
    """Per-user rating aggregates (partial aggregation runs map-side, so a
    user holding a large share of the rows costs one row per map task)."""
    return stg_ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg("rating").alias("avg_rating_given"),
        F.min("rating_timestamp").alias("first_rating_at"),
        F.max("rating_timestamp").alias("last_rating_at"),
    )


def tag_activity(stg_tags: DataFrame) -> DataFrame:
    return stg_tags.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_tags"),
        F.min("tag_timestamp").alias("first_tag_at"),
        F.max("tag_timestamp").alias("last_tag_at"),
    )


def dim_users_from_activity(r: DataFrame, t: DataFrame) -> DataFrame:
    """Finish M7 from the two per-user aggregates: one full outer join on the
    key, which is unique on both sides. Activity without a user belongs to
    nobody: it is one row of counts 0, and only where there is such activity.
    """
    known = F.col("user_id").isNotNull()
    nobody = r.where(~known).select("user_id").unionByName(t.where(~known).select("user_id")).distinct()
    j = (r.where(known).join(t.where(known), "user_id", "full_outer")
         .unionByName(nobody, allowMissingColumns=True))
    return j.select(
        "user_id",
        F.coalesce("n_ratings", F.lit(0)).cast("long").alias("n_ratings"),
        F.coalesce("n_tags", F.lit(0)).cast("long").alias("n_tags"),
        "avg_rating_given",
        "first_rating_at",
        "last_rating_at",
        "first_tag_at",
        "last_tag_at",
        month_start("first_rating_at").alias("cohort_month"),
        days_crossed("first_rating_at", "last_rating_at").alias("active_span_days"),
        (F.coalesce("n_tags", F.lit(0)) > 0).alias("has_tagged"),
    )


def dim_users(stg_ratings: DataFrame, stg_tags: DataFrame) -> DataFrame:
    """M7: aggregate each stream first, then join (no fan-out).

    Cohort is the month of the first *rating*: NULL for tag-only users.
    """
    return dim_users_from_activity(rating_activity(stg_ratings), tag_activity(stg_tags))


def dim_genome_tags(stg_genome_tags: DataFrame) -> DataFrame:
    """M8."""
    return stg_genome_tags.select("tag_id", title_case(F.trim("tag")).alias("tag_name"))
