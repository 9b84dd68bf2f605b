"""The declared checks (106, as in the reference, plus the extra SCD2 mode)
and the relations they run on.

``declared_checks`` is the registry: relation -> list of checks. The list
mirrors the reference's declarations column by column; bounds and value lists
are fixed values. ``check_summary`` runs all of them and returns one row per
(relation, check) with its violation count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.checks import (Check, accepted_values, between, expression_is_true,
                                no_overlapping_versions, not_null, relationships,
                                summarize_all, unique, unique_combination)
from ..session import configure
from ..sources import testdata
from . import dims, facts, history, marts, staging
from . import inputs as I

# --- fixed values -------------------------------------------------------------
# Accepted genre groups of the reference taxonomy.
REFERENCE_GENRE_GROUPS = (
    "Action & Adventure", "Speculative", "Crime & Mystery", "Drama & Romance", "Comedy",
    "Family & Animation", "Non-fiction", "Format", "Unclassified",
)
# Accepted genre groups of the test-data taxonomy (seeds/genre_groups_testdata.csv).
TESTDATA_GENRE_GROUPS = ("Package", "Format", "Colour", "Temperature", "Size", "Age",
                         "Object", "Unclassified")
# -----------------------------------------------------------------------------

NN = not_null


def declared_checks(genre_groups: tuple[str, ...] = REFERENCE_GENRE_GROUPS,
                    include_extra: bool = True) -> dict[str, list[Check]]:
    c: dict[str, list[Check]] = {
        # sources
        "raw_movies": [unique("movieId"), NN("movieId")],
        "raw_ratings": [NN("userId"), NN("movieId"), NN("rating")],
        "raw_tags": [NN("userId"), NN("movieId")],
        "raw_genome_scores": [NN("movieId"), NN("tagId")],
        "raw_genome_tags": [unique("tagId"), NN("tagId"), NN("tag")],
        # staging
        "stg_movies": [unique("movie_id"), NN("movie_id")],
        "stg_ratings": [NN("user_id"), NN("movie_id"), NN("rating"), NN("rating_timestamp")],
        "stg_tags": [NN("user_id"), NN("movie_id"), NN("tag_timestamp")],
        "stg_genome_scores": [NN("movie_id"), NN("tag_id"), NN("relevance")],
        "stg_genome_tags": [unique("tag_id"), NN("tag_id"), NN("tag")],
        # dimensions
        "dim_movies": [unique("movie_id"), NN("movie_id"), NN("movie_title"),
                       between("release_year", 1870, 2030, "release_year is not null"),
                       NN("is_unclassified")],
        "dim_users": [unique("user_id"), NN("user_id"),
                      NN("n_ratings"), between("n_ratings", 0),
                      NN("n_tags"), between("n_tags", 0),
                      between("avg_rating_given", 0.5, 5.0, "avg_rating_given is not null"),
                      between("active_span_days", 0, None, "active_span_days is not null"),
                      NN("has_tagged")],
        "dim_genome_tags": [unique("tag_id"), NN("tag_id"), NN("tag_name"), unique("tag_name")],
        # facts
        "fct_ratings": [unique_combination(["user_id", "movie_id"]),
                        NN("user_id"), relationships("user_id", "dim_users", "user_id"),
                        NN("movie_id"), relationships("movie_id", "dim_movies", "movie_id"),
                        NN("rating"), between("rating", 0.5, 5.0),
                        NN("rating_timestamp")],
        "fct_genome_scores": [unique_combination(["movie_id", "tag_id"]),
                              NN("movie_id"), relationships("movie_id", "dim_movies", "movie_id"),
                              NN("tag_id"), relationships("tag_id", "dim_genome_tags", "tag_id"),
                              NN("relevance_score"), between("relevance_score", 0, 1)],
        "fct_movie_rating_daily": [unique_combination(["movie_id", "rating_date"]),
                                   NN("movie_id"),
                                   relationships("movie_id", "dim_movies", "movie_id"),
                                   NN("rating_date"), NN("n_ratings"), between("n_ratings", 1),
                                   between("avg_rating", 0.5, 5.0),
                                   NN("n_ratings_7d"), NN("n_ratings_28d"),
                                   expression_is_true("n_ratings_28d", ">= n_ratings_7d"),
                                   between("avg_rating_28d", 0.5, 5.0)],
        "int_movie_tag_relevance": [NN("movie_id"), NN("genre"), NN("tag_id"), NN("tag_name"),
                                    NN("relevance_score")],
        # marts
        "mart_tag_genre_affinity": [unique_combination(["genre", "tag_id"]),
                                    NN("genre_group"), NN("genre"), NN("tag_id"), NN("tag_name"),
                                    NN("n_movies"), NN("avg_relevance"),
                                    between("avg_relevance", 0, 1),
                                    between("median_relevance", 0, 1),
                                    between("relevance_lift_vs_all_genres", -1, 1),
                                    NN("tag_rank_in_genre")],
        "mart_user_cohort_retention": [unique_combination(["cohort_month", "months_since_first_rating"]),
                                       NN("cohort_month"), NN("cohort_size"),
                                       between("cohort_size", 1),
                                       NN("months_since_first_rating"),
                                       between("months_since_first_rating", 0),
                                       NN("active_users"), NN("retention_rate"),
                                       between("retention_rate", 0, 1)],
        # seed and snapshot
        "seed_genre_groups": [unique("genre"), NN("genre"), NN("genre_group"),
                              accepted_values("genre_group", genre_groups),
                              NN("is_format_not_genre")],
        "snap_movies": [no_overlapping_versions("movie_id", allow_closed_entities=True,
                                                allow_gaps=True),
                        NN("movie_id"), unique("scd_id"), NN("scd_id"), NN("valid_from")],
    }
    if include_extra:
        c["snap_movies"].append(no_overlapping_versions("movie_id", extra_only=True))
    return c


def testdata_relations(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Every checked relation, built from the driver tables.

    Relations the reference materialises as tables are audited as stored:
    each is computed once into the shared checkpoint folder as it is built,
    and its checks and dependents read that copy instead of recomputing it
    per consumer. So are the two sources that are a join and an aggregate of
    the test tables (an extract is a stored table), and the ephemeral
    relation, which has checks of its own besides its consumer. Views stay
    lazy.
    """
    from .incremental import stored
    configure(spark)
    t: dict[str, DataFrame] = {
        "raw_movies": testdata.raw_movies(spark, d),
        "raw_ratings": stored(testdata.raw_ratings(spark, d).select("userId", "movieId", "rating", "timestamp")),
        "raw_tags": testdata.raw_tags(spark, d),
        "raw_genome_scores": stored(testdata.raw_genome_scores(spark, d)),
        "raw_genome_tags": testdata.raw_genome_tags(spark, d),
    }
    t["stg_movies"] = staging.stg_movies(t["raw_movies"])
    t["stg_ratings"] = staging.stg_ratings(t["raw_ratings"])
    t["stg_tags"] = staging.stg_tags(t["raw_tags"])
    t["stg_genome_scores"] = staging.stg_genome_scores(t["raw_genome_scores"])
    t["stg_genome_tags"] = staging.stg_genome_tags(t["raw_genome_tags"])
    t["dim_movies"] = stored(dims.dim_movies(t["stg_movies"]))
    t["dim_users"] = stored(dims.dim_users(t["stg_ratings"], t["stg_tags"]))
    t["dim_genome_tags"] = stored(dims.dim_genome_tags(t["stg_genome_tags"]))
    t["fct_ratings"] = stored(facts.fct_ratings_full(t["stg_ratings"]))
    t["fct_genome_scores"] = facts.fct_genome_scores(t["stg_genome_scores"])
    t["fct_movie_rating_daily"] = stored(facts.movie_rating_daily(t["fct_ratings"]))
    t["int_movie_tag_relevance"] = stored(marts.int_movie_tag_relevance(
        t["dim_movies"], t["fct_genome_scores"], t["dim_genome_tags"]))
    t["seed_genre_groups"] = I.genre_groups(spark)
    t["mart_tag_genre_affinity"] = stored(marts.mart_tag_genre_affinity(
        t["int_movie_tag_relevance"], t["seed_genre_groups"]))
    t["mart_user_cohort_retention"] = stored(
        marts.mart_user_cohort_retention(t["dim_users"], t["fct_ratings"]))
    t["snap_movies"] = history.snap_movies(spark, d)
    return t


def run_checks(tables: dict[str, DataFrame], checks: dict[str, list[Check]]) -> DataFrame:
    """(relation, check, kind, n_violations) for every declared check."""
    return summarize_all({rel: (tables[rel], cs) for rel, cs in checks.items()}, tables)


def check_summary(spark: SparkSession, d: str) -> DataFrame:
    return run_checks(testdata_relations(spark, d), declared_checks(TESTDATA_GENRE_GROUPS))
