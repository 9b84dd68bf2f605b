"""The intermediate relevance relation and the two marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_start, months_crossed, round_half_up, safe_ratio
from ..operators.median import median_from_counts


# ---------------------------------------------------- int_movie_tag_relevance

def movie_genres(dim_movies: DataFrame) -> DataFrame:
    """J9 + P6: one row per listed genre of a classified film.

    ``explode`` (not ``explode_outer``) drops NULL/empty arrays; ``where(~flag)``
    drops a NULL flag too (three-valued logic, as in ``WHERE NOT flag``). A
    genre listed twice stays twice.
    """
    return (dim_movies.where(~F.col("is_unclassified"))
            .select("movie_id", F.explode("genre_array").alias("genre")))


def int_movie_tag_relevance(dim_movies: DataFrame, fct_genome_scores: DataFrame,
                            dim_genome_tags: DataFrame) -> DataFrame:
    """(film, genre, tag) with the film's relevance for the tag.

    J3/J4 are inner equi-joins. No broadcast is forced: film-genres grows with
    the catalogue and the tag vocabulary is data, so AQE picks a broadcast at
    runtime only when the measured side is under its threshold.
    """
    mg = movie_genres(dim_movies)
    return (mg.join(fct_genome_scores, "movie_id", "inner")
            .join(dim_genome_tags, "tag_id", "inner")
            .select("movie_id", "genre", "tag_id", "tag_name", "relevance_score"))


# ---------------------------------------------------- mart_tag_genre_affinity

def genre_tag_stats(relevance: DataFrame) -> DataFrame:
    """Per (genre, tag): distinct films, mean and exact median relevance.

    1. The histogram (tag, genre, score, name) with its row counts, and as
       films the first rows of each film (of its lowest score, a NULL score
       if it has no other), so that a film counts once however often it
       lists the genre;
    2. one window pass and one aggregate for the median, the mean
       (sum(score * n) / sum(n)) and the film count
       (``COUNT(DISTINCT movie_id)`` with NULL scores included).

    Every aggregate is combinable and none keeps a list: a (genre, tag)
    holding a third of the rows costs one row per distinct rounded score in
    the window. The name is a key until the end, as a maximum of strings
    would sort the rows instead of hashing them; numbers lead the sorts.
    """
    keys = ["tag_id", "genre"]
    score = F.col("relevance_score")
    lowest = Window.partitionBy("movie_id", *keys).orderBy(score.asc_nulls_last(), "tag_name")
    marked = relevance.withColumn("_first", F.row_number().over(lowest) == 1)
    counts = marked.groupBy(*keys, "relevance_score", "tag_name").agg(
        F.count_if(score.isNotNull()).alias("_cnt"), F.count_if("_first").alias("_films"))
    return median_from_counts(counts, keys, "relevance_score", "median_relevance", mean="avg_relevance",
                              extra={"n_movies": F.sum("_films"), "tag_name": F.max("tag_name")})


def mart_tag_genre_affinity(relevance: DataFrame, genre_groups: DataFrame) -> DataFrame:
    """M13.

    The taxonomy join is a LEFT join (an unmapped genre survives with a NULL
    group, for the not_null check to catch), the format filter keeps NULL
    flags (``NOT COALESCE(flag, FALSE)``), and it runs *before* the
    cross-genre baseline so formats do not enter the baseline. The baseline is
    the unweighted mean of per-genre means; rank uses the unrounded lift.
    """
    stats = genre_tag_stats(relevance)
    scored = (stats.join(genre_groups.select(
                  "genre", "genre_group", "is_format_not_genre"), "genre", "left")
              .where(~F.coalesce(F.col("is_format_not_genre"), F.lit(False))))
    lift = F.col("avg_relevance") - F.avg("avg_relevance").over(Window.partitionBy("tag_id"))
    rank_w = Window.partitionBy("genre").orderBy(F.col("_lift").desc_nulls_last())
    return (scored.withColumn("_lift", lift)
            .select("genre_group", "genre", "tag_id", "tag_name", "n_movies",
                    round_half_up("avg_relevance", 4).alias("avg_relevance"),
                    round_half_up("median_relevance", 4).alias("median_relevance"),
                    round_half_up("_lift", 4).alias("relevance_lift_vs_all_genres"),
                    F.rank().over(rank_w).alias("tag_rank_in_genre")))


def genre_top_tags(affinity: DataFrame, k: int = 10) -> DataFrame:
    """O2: top-k tags per genre by consuming the stored rank (ties kept)."""
    return affinity.where(F.col("tag_rank_in_genre") <= k)


# ------------------------------------------------- mart_user_cohort_retention

def user_months(fct_ratings: DataFrame) -> DataFrame:
    """X2 bridge: distinct (user, activity month).

    Reducing the facts to this grain first is the scale fix for the retention
    mart: the distinct is combinable map-side, and the join to users then sees
    one row per (user, month) instead of one per rating, so a user with a huge
    share of the ratings cannot skew it.
    """
    return (fct_ratings.select("user_id", month_start("rating_timestamp").alias("activity_month"))
            .distinct())


def mart_user_cohort_retention(dim_users: DataFrame, fct_ratings: DataFrame) -> DataFrame:
    """Retention by first-rating cohort and month offset.

    Same relation as DISTINCT (cohort, user, offset) over ratings x users,
    computed as DISTINCT (user, month) first (see ``user_months``). Offsets
    with no active user have no row. Cohort sizes are one row per month.
    """
    users = dim_users.where(F.col("first_rating_at").isNotNull()).select("user_id", "cohort_month")
    activity = (user_months(fct_ratings).join(users, "user_id", "inner")
                .select("cohort_month", "user_id",
                        months_crossed("cohort_month", "activity_month")
                        .alias("months_since_first_rating")))
    active = (activity.groupBy("cohort_month", "months_since_first_rating")
              .agg(F.count(F.lit(1)).alias("active_users")))
    sizes = users.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (active.join(sizes, "cohort_month", "inner")
            .select("cohort_month", "cohort_size", "months_since_first_rating", "active_users",
                    round_half_up(safe_ratio("active_users", "cohort_size"), 4)
                    .alias("retention_rate")))
