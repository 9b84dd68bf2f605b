"""Structured Streaming forms of the incremental models.

The reference runs its incremental models as scheduled batches; the same
functions run live here:

* ``start_ratings_upsert``: new raw rating files -> staging -> merge into
  fct_ratings (S7, X5) and re-derive the touched window of
  the daily fact (S9/S10), once per micro-batch in ``foreachBatch``, by the
  same staged merge as the build (``plans.fact_build``). The merge
  is idempotent (same batch twice = same table), so a micro-batch replayed
  after an executor or driver loss leaves the table as if it ran once; the
  streaming checkpoint records which files each batch consumed.
* ``start_user_activity``: the X3 mergeable user state kept by the streaming
  aggregation itself (count, sum, min, max per user in the state store),
  emitted in update mode and upserted into the user-activity table.

Checkpoints go under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_per_key
from ..plans import fact_build, facts, staging
from ..session import scratch_path
from ..sources.tables import FactTable

BUCKETS = 16


def merge_ratings_batch(spark: SparkSession, batch: DataFrame, ratings_path: str,
                        buckets: int = BUCKETS, order: tuple[str, ...] = ("rating_timestamp",)) -> None:
    """Merge one batch of staged ratings into the fct_ratings table at ``ratings_path``.

    Within the batch the latest row per (user, film) wins (``order`` must be
    total within a key); against the table the later event wins and on equal
    times the batch does, so replaying a batch or receiving rows out of order
    cannot move a key backwards.
    """
    table = fact_build.ratings_table(FactTable.at, spark, ratings_path)
    latest = latest_per_key(batch, list(facts.RATING_KEYS), order, ["rating"]).select(*facts.RATING_COLS)
    fact_build.merge_ratings(table, latest, buckets, newer="rating_timestamp").publish()


def refresh_daily(spark: SparkSession, ratings_path: str, daily_path: str) -> None:
    """Recompute the daily fact's lookback window from fct_ratings and replace
    the touched months (whole months, so emptied days disappear)."""
    ratings = fact_build.ratings_table(FactTable.at, spark, ratings_path).read()
    daily = fact_build.daily_table(FactTable.at, spark, daily_path)
    fact_build.merge_daily(daily, ratings, whole_months=True).publish()


def start_ratings_upsert(spark: SparkSession, source_dir: str, schema: T.StructType,
                         ratings_path: str, daily_path: str | None = None,
                         checkpoint: str | None = None, fmt: str = "parquet",
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         buckets: int = BUCKETS) -> StreamingQuery:
    """Stream raw rating files into fct_ratings (and the daily fact)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_dir)
    staged = staging.stg_ratings(raw)

    def each(batch: DataFrame, epoch_id: int) -> None:
        merge_ratings_batch(spark, batch, ratings_path, buckets)
        if daily_path:
            refresh_daily(spark, ratings_path, daily_path)

    w = (staged.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "streams/ratings_upsert")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_user_activity(spark: SparkSession, source_dir: str, schema: T.StructType,
                        activity_path: str, checkpoint: str | None = None, fmt: str = "parquet",
                        available_now: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """X3 as a streaming aggregation: per-user (n, sum, min, max) kept in the
    state store; each micro-batch emits the users it changed (update mode),
    which replace their rows in the activity table (bucketed by user)."""
    raw = spark.readStream.schema(schema).format(fmt).load(source_dir)
    agg = (staging.stg_ratings(raw).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.sum("rating").alias("sum_rating"),
        F.min("rating_timestamp").alias("first_rating_at"),
        F.max("rating_timestamp").alias("last_rating_at")))

    def each(batch: DataFrame, epoch_id: int) -> None:
        new = batch.withColumn(fact_build.BUCKET, F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))
        table = FactTable.at(spark, activity_path, fact_build.BUCKET)
        made = fact_build.upsert(table, new, ["user_id"]) if table.exists() else fact_build.first(table, new, ["user_id"])
        made.publish()

    w = (agg.writeStream.outputMode("update").foreachBatch(each)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "streams/user_activity")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
