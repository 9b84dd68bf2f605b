"""Source profiling queries (the reference's verification table).

Each is a single aggregate or anti-join over whole relations and returns a
small result; nothing is collected inside the functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_half_up, safe_ratio
from ..functions.text import NO_GENRES


def _metrics(df: DataFrame, **aggs) -> DataFrame:
    """One aggregate pass over ``df`` returned as (metric, value) rows."""
    row = df.agg(*[c.cast("double").alias(k) for k, c in aggs.items()])
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value"))
                                for k in aggs]))
    return row.select(stack.alias("m")).select("m.*")


def _dup_count(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Number of key values (non-NULL) that occur more than once."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    per_key = df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _metrics(per_key, **{metric: F.count_if(F.col("n") > 1)})


def profile_keys(ratings: DataFrame, movies: DataFrame, genome_tags: DataFrame) -> DataFrame:
    """R1 + R4: duplicate (user, film) pairs; duplicate film ids, tag ids, tag
    texts. Rows (metric, value)."""
    return (_dup_count(ratings, ["user_id", "movie_id"], "dup_rating_pairs")
            .unionByName(_dup_count(movies, ["movie_id"], "dup_movie_ids"))
            .unionByName(_dup_count(genome_tags, ["tag_id"], "dup_tag_ids"))
            .unionByName(_dup_count(genome_tags, ["tag"], "dup_tag_texts")))


def profile_ranges(ratings: DataFrame, genome_scores: DataFrame) -> DataFrame:
    """R2 + R3 + R5: null ratings, observed rating range, relevance <= 0 and
    its minimum. Rows (metric, value)."""
    r = _metrics(ratings, null_ratings=F.count_if(F.col("rating").isNull()),
                 min_rating=F.min("rating"), max_rating=F.max("rating"),
                 n_ratings=F.count(F.lit(1)))
    g = _metrics(genome_scores, nonpositive_relevance=F.count_if(F.col("relevance") <= 0),
                 min_relevance=F.min("relevance"), n_scores=F.count(F.lit(1)))
    return r.unionByName(g)


def profile_ties(ratings: DataFrame) -> DataFrame:
    """Share of rows that share their timestamp with another row, and share
    of distinct timestamps that are ties."""
    per_ts = ratings.groupBy("rating_timestamp").agg(F.count(F.lit(1)).alias("n"))
    return (per_ts.agg(F.sum("n").alias("n_rows"),
                       F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("tied_rows"),
                       F.count(F.lit(1)).alias("n_timestamps"),
                       F.count_if(F.col("n") > 1).cast("long").alias("tied_timestamps"))
            .select("n_rows", "tied_rows", "n_timestamps", "tied_timestamps",
                    round_half_up(safe_ratio("tied_rows", "n_rows"), 4).alias("tied_row_share"),
                    round_half_up(safe_ratio("tied_timestamps", "n_timestamps"), 4)
                    .alias("tied_timestamp_share")))


def profile_vocab(movies: DataFrame, genre_groups: DataFrame) -> DataFrame:
    """Genre vocabulary of the films vs the taxonomy, both directions.

    Rows: (genre, side, n_films) where side is 'missing_from_seed' (listed by
    films, absent from the seed) or 'unused_by_films' (in the seed, never
    listed; n_films 0). The '(no genres listed)' marker counts as a listing.
    """
    listed = (movies.select("movie_id", F.explode(F.split("genres", r"\|")).alias("genre"))
              .groupBy("genre").agg(F.count_distinct("movie_id").alias("n_films")))
    seed = genre_groups.select("genre")
    missing = (listed.join(seed, "genre", "left_anti")
               .select("genre", F.lit("missing_from_seed").alias("side"), "n_films"))
    unused = (seed.join(listed, "genre", "left_anti")
              .select("genre", F.lit("unused_by_films").alias("side"),
                      F.lit(0).cast("long").alias("n_films")))
    return missing.unionByName(unused)


def profile_tag_only_users(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """Users who tag but never rate."""
    taggers = tags.select("user_id").distinct()
    return taggers.join(ratings.select("user_id").distinct(), "user_id", "left_anti")


def profile_years(dim_movies: DataFrame) -> DataFrame:
    """Films without a parsed year, told apart: 'malformed' when the title
    holds a parenthesised four-digit year that the strict parse rejected,
    'absent' otherwise."""
    return (dim_movies.where(F.col("release_year").isNull())
            .select("movie_id", "source_title",
                    F.when(F.col("source_title").rlike(r"\(\d{4}"), F.lit("malformed"))
                    .otherwise(F.lit("absent")).alias("reason")))


def profile_orphans(genome_scores: DataFrame, movies: DataFrame) -> DataFrame:
    """Films referenced by the score matrix but missing from the films,
    with the number of orphaned score rows each."""
    per_film = genome_scores.groupBy("movie_id").agg(F.count(F.lit(1)).alias("orphan_rows"))
    return per_film.join(movies.select("movie_id").distinct(), "movie_id", "left_anti")


__all__ = ["profile_keys", "profile_ranges", "profile_ties", "profile_vocab",
           "profile_tag_only_users", "profile_years", "profile_orphans", "NO_GENRES"]
