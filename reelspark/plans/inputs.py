"""Model inputs built from the driver's test tables (FIXTURES.md part B).

Each function returns a lazy DataFrame over the *whole* tables in ``sf_dir``;
nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources import seeds, testdata
from . import dims, facts, marts, staging

# Line-item columns that make (time, order, line, supplier) a total order
# within a (user, film) key.
TIEBREAK = ("l_orderkey", "l_linenumber", "l_suppkey")
CARRY = TIEBREAK + ("arrived_at",)


def ratings(spark: SparkSession, d: str, item: str = "part",
            keep: tuple[str, ...] = CARRY) -> DataFrame:
    configure(spark)
    raw = testdata.raw_ratings(spark, d, item)
    return staging.stg_ratings(raw, keep=keep)


def tags(spark: SparkSession, d: str) -> DataFrame:
    configure(spark)
    return staging.stg_tags(testdata.raw_tags(spark, d))


def movies(spark: SparkSession, d: str) -> DataFrame:
    configure(spark)
    return staging.stg_movies(testdata.raw_movies(spark, d))


def genome_scores(spark: SparkSession, d: str) -> DataFrame:
    configure(spark)
    return staging.stg_genome_scores(testdata.raw_genome_scores(spark, d))


def genome_tags(spark: SparkSession, d: str) -> DataFrame:
    configure(spark)
    return staging.stg_genome_tags(testdata.raw_genome_tags(spark, d))


def genre_groups(spark: SparkSession) -> DataFrame:
    return seeds.load_seed(spark, seeds.GENRE_GROUPS_TESTDATA)


def dim_movies(spark, d):
    return dims.dim_movies(movies(spark, d))


def dim_users(spark, d):
    return dims.dim_users(ratings(spark, d), tags(spark, d))


def dim_genome_tags(spark, d):
    return dims.dim_genome_tags(genome_tags(spark, d))


def fct_genome_scores(spark, d):
    return facts.fct_genome_scores(genome_scores(spark, d))


def fct_ratings(spark, d, dedupe: bool = False):
    return facts.fct_ratings_full(ratings(spark, d), dedupe=dedupe, tiebreak=TIEBREAK)


def tag_relevance(spark, d):
    return marts.int_movie_tag_relevance(dim_movies(spark, d), fct_genome_scores(spark, d),
                                         dim_genome_tags(spark, d))


def genre_affinity(spark, d):
    return marts.mart_tag_genre_affinity(tag_relevance(spark, d), genre_groups(spark))
