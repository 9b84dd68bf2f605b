"""M1-M5: staging. Rename camelCase -> snake_case and type the event time.

Nothing else happens here (no filtering, no parsing): staging reports what
arrived. Extra columns named in ``keep`` ride along untouched (the test
derivations carry line-item keys for tie-breaking).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import to_timestamp_any


def _ts(df: DataFrame, name: str):
    return to_timestamp_any(name, df.schema[name].dataType)


def stg_movies(raw: DataFrame) -> DataFrame:
    """M1."""
    return raw.select(F.col("movieId").alias("movie_id"), "title", "genres")


def stg_ratings(raw: DataFrame, keep: tuple[str, ...] = (), since_us: int | None = None) -> DataFrame:
    """M2: epoch seconds (or timestamp_ntz) -> timestamp.

    ``since_us`` keeps the rows at or after an instant (microseconds since
    1970, UTC). It is compared with the raw column, so the scan can skip.
    """
    if since_us is not None:
        kind = raw.schema["timestamp"].dataType
        mark = (F.lit(since_us // 1_000_000) if isinstance(kind, T.LongType)
                else F.timestamp_micros(F.lit(since_us)).cast(kind))
        raw = raw.where(F.col("timestamp") >= mark)
    return raw.select(F.col("userId").alias("user_id"),
                      F.col("movieId").alias("movie_id"),
                      F.col("rating").cast("double").alias("rating"),
                      _ts(raw, "timestamp").alias("rating_timestamp"),
                      *keep)


def stg_tags(raw: DataFrame) -> DataFrame:
    """M3: the tag text stays nullable."""
    return raw.select(F.col("userId").alias("user_id"),
                      F.col("movieId").alias("movie_id"),
                      "tag",
                      _ts(raw, "timestamp").alias("tag_timestamp"))


def stg_genome_scores(raw: DataFrame) -> DataFrame:
    """M4."""
    return raw.select(F.col("movieId").alias("movie_id"),
                      F.col("tagId").alias("tag_id"),
                      F.col("relevance").cast("double").alias("relevance"))


def stg_genome_tags(raw: DataFrame) -> DataFrame:
    """M5."""
    return raw.select(F.col("tagId").alias("tag_id"), "tag")
