"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the whole driver tables under ``sf_dir`` through ``inputs`` and
runs one model or operator of the blueprint. ``oracle.oracle_sql`` holds the
DuckDB twin under the same name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import lit_of
from . import dims, facts, marts
from . import history as H
from . import incremental as INC
from . import inputs as I
from . import profile as P
from . import quality as Q
from . import retention

# --- fixed values of the queries whose checks fire ----------------------------
EARLY = dt.datetime(1993, 1, 1)
FRESHNESS_LOADED = dt.datetime(1997, 6, 1)
FRESHNESS_NOW = dt.datetime(1997, 6, 25, 18)
# -----------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def daily_rolling(spark, d):
    """M2 -> M9 (first build) -> M11 full refresh; film = part."""
    return facts.movie_rating_daily(I.fct_ratings(spark, d))


def daily_rolling_dense(spark, d):
    """Same with film = supplier: ~27 ratings per (film, day), so the 7- and
    28-day frames really aggregate several days."""
    return facts.movie_rating_daily(
        facts.fct_ratings_full(I.ratings(spark, d, item="supplier")))


def movies_dim(spark, d):
    return I.dim_movies(spark, d)


def users_dim(spark, d):
    return I.dim_users(spark, d)


def genome_tags_dim(spark, d):
    return I.dim_genome_tags(spark, d)


def genome_scores(spark, d):
    return I.fct_genome_scores(spark, d)


def tag_relevance(spark, d):
    return I.tag_relevance(spark, d)


def genre_affinity(spark, d):
    return I.genre_affinity(spark, d)


def genre_top_tags(spark, d):
    return marts.genre_top_tags(I.genre_affinity(spark, d), k=10)


def cohort_retention(spark, d):
    return marts.mart_user_cohort_retention(I.dim_users(spark, d), I.fct_ratings(spark, d))


def ratings_latest(spark, d):
    return I.fct_ratings(spark, d, dedupe=True)


# ------------------------------------------------------- DML, SCD2, history

def conditional_update(spark, d):
    """S18 (+ H16, H17, P10): the two staged UPDATEs over the whole film source."""
    return H.reclassify_and_correct(H.extracts(spark, d)[0])


def insert_if_absent(spark, d):
    """Run-2 extract = updates + a title inserted if absent."""
    return H.extracts(spark, d)[1]


def delete_where(spark, d):
    """Run-3 extract = the inserted title deleted again."""
    return H.extracts(spark, d)[2]


def snapshot_history(spark, d):
    """History after four snapshot runs (incl. reinstatement)."""
    return H.snap_movies(spark, d)


def snapshot_state(spark, d):
    """R11."""
    return H.snapshot_state(H.snap_movies(spark, d))


def snapshot_withdrawn(spark, d):
    """R12 generalised: history of keys with no open version, inspected after
    the hard delete (run 3), as the reference's inspection script is."""
    return H.withdrawn_history(H.snap_movies(spark, d, n_runs=3))


def snapshot_accounting(spark, d):
    """R13."""
    return H.snapshot_accounting(H.snap_movies(spark, d))


def snapshot_multi_open(spark, d):
    """R14."""
    return H.multi_open(H.snap_movies(spark, d))


def scd2_violations(spark, d):
    """Q8a-d + open_window_superseded, strict flags (gaps of reinstated keys show)."""
    return H.history_violations(H.snap_movies(spark, d))


def scd2_violations_declared(spark, d):
    """Q8 with the flags the snapshot declares (closed entities and gaps allowed)."""
    return H.history_violations(H.snap_movies(spark, d), allow_closed_entities=True,
                                allow_gaps=True)


# --------------------------------------------------- incremental and scale (X)


def retention_approx(spark, d):
    """Retention from sketches that two loads have stored (rows-only: approximate; ``retention_sketch_bounds``
    holds it against the exact numbers)."""
    return INC.sketched_retention(spark, d)


def retention_sketch_bounds(spark, d):
    """Whether each approximate number of active users is within three deviations of the exact one."""
    r = INC.staged_ratings(spark, d, facts.RATING_COLS)
    users = INC.stored(dims.dim_users(r, I.tags(spark, d)))
    exact = marts.mart_user_cohort_retention(users, facts.fct_ratings_full(r)).withColumnRenamed("active_users", "exact")
    near = F.abs(F.col("active_users") - F.col("exact")) <= 3 * retention.RSD * F.col("exact")
    return (INC.sketched_loads(spark, d, r, users).drop("cohort_size", "retention_rate")
            .join(exact, ["cohort_month", "months_since_first_rating"], "full")
            .select("cohort_month", "months_since_first_rating", F.coalesce(near, F.lit(False)).alias("within_bound")))


def bridge_active_users(spark, d):
    """Users of each month, from the bitmaps that two loads have stored."""
    return retention.active_users(INC.stored_bridge(spark, d))


def retention_bridge(spark, d):
    """M14, exact, from the stored bitmaps."""
    return retention.retention_from_bridge(I.dim_users(spark, d), INC.stored_bridge(spark, d))


def user_month_bridge(spark, d):
    """Distinct (user, month) bridge under the retention mart."""
    return marts.user_months(I.fct_ratings(spark, d))


# ------------------------------------------------------- profiling and checks


def profile_keys(spark, d):
    """R1 + R4."""
    return P.profile_keys(I.ratings(spark, d), I.movies(spark, d), I.genome_tags(spark, d))


def profile_ranges(spark, d):
    """R2 + R3 + R5."""
    return P.profile_ranges(I.ratings(spark, d), I.genome_scores(spark, d))


def profile_ties(spark, d):
    """R7."""
    return P.profile_ties(I.ratings(spark, d))


def profile_vocab(spark, d):
    """R6."""
    return P.profile_vocab(I.movies(spark, d), I.genre_groups(spark))


def profile_vocab_reference(spark, d):
    """R6 against the reference's own taxonomy: every test genre is missing
    from it and every reference genre is unused (both directions non-empty)."""
    from ..sources import seeds
    return P.profile_vocab(I.movies(spark, d), seeds.load_seed(spark, seeds.GENRE_GROUPS))


def profile_tag_only_users(spark, d):
    """R8."""
    return P.profile_tag_only_users(I.ratings(spark, d), I.tags(spark, d))


def profile_years(spark, d):
    """R9."""
    return P.profile_years(I.dim_movies(spark, d))


def profile_orphans(spark, d):
    """R10."""
    return P.profile_orphans(I.genome_scores(spark, d), I.movies(spark, d))


def check_summary(spark, d):
    """Q1-Q8: every declared check (106 + the extra SCD2 mode) with its count."""
    return Q.check_summary(spark, d)


def _solvent(spark, d):
    return spark.read.parquet(f"{d.rstrip('/')}/supplier.parquet").where("s_acctbal >= 0")


def checks_fired(spark, d):
    """Q1-Q7 on line items with rules that real rows break: every check has violations."""
    from ..operators import checks as C
    lines = (spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet")
             .withColumn("rebate", F.expr("nullif(l_discount, 0)")))
    rules = [C.not_null("rebate"), C.accepted_values("l_returnflag", ["A", "N"]), C.between("l_quantity", 5, 45),
             C.expression_is_true("l_extendedprice", ">= 2000 * l_quantity"), C.unique("l_orderkey"),
             C.unique_combination(["l_partkey", "l_suppkey"]), C.relationships("l_suppkey", "solvent", "s_suppkey")]
    return C.summarize("lineitem", lines, rules, {"solvent": _solvent(spark, d)}).select("check", "n_violations")


def windows_fired(spark, d):
    """Q8a-d and the extra mode on a customer's order days as versions: open, shipped after 90 days, or ended
    the day before they began, by the day's last status. Violations by mode."""
    from ..operators import checks as C
    orders = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    days = orders.groupBy("o_custkey", F.col("o_orderdate").alias("valid_from")).agg(F.max("o_orderstatus").alias("s"))
    until = (F.when(F.col("s") == "F", F.expr("valid_from + INTERVAL 90 DAYS"))
             .when(F.col("s") == "P", F.expr("valid_from - INTERVAL 1 DAY")))
    found = C.version_violations(days.withColumn("valid_to", until), "o_custkey")
    return found.groupBy("failure_mode").agg(F.count(F.lit(1)).alias("n_violations"))


def profile_tag_only_users_fired(spark, d):
    """R8 where it has rows: taggers who had not rated before a day."""
    early = I.ratings(spark, d).where(F.col("rating_timestamp") < lit_of(EARLY))
    return P.profile_tag_only_users(early, I.tags(spark, d))


def profile_orphans_fired(spark, d):
    """R10 where it has rows: scores against the first film extract, which lacks the late films."""
    return P.profile_orphans(I.genome_scores(spark, d), H.first_extract(I.movies(spark, d)))


def snapshot_multi_open_fired(spark, d):
    """R14 where it has rows: a customer's order days as versions, open while the day's last status is."""
    orders = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    days = orders.groupBy(F.col("o_custkey").alias("movie_id"), F.col("o_orderdate").alias("valid_from")).agg(F.max("o_orderstatus").alias("s"))
    return H.multi_open(days.withColumn("valid_to", F.when(F.col("s") != "O", F.col("valid_from"))))


# ----------------------------------------------------------------- freshness

def freshness_by_source(spark, d):
    """S16 at a given time: each customer as a source, the last order before a day as the last load (some have none)."""
    from ..sources.freshness import load_status
    read = lambda name: spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")
    orders = read("orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("at")).where(F.col("at") < lit_of(FRESHNESS_LOADED))
    last = orders.groupBy("o_custkey").agg(F.max("at").alias("last_loaded_at"))
    loads = (read("customer").select(F.col("c_name").alias("source"), "c_custkey")
             .join(last, F.col("o_custkey") == F.col("c_custkey"), "left"))
    return load_status(loads, FRESHNESS_NOW).select("source", "last_loaded_at", "status")


def freshness(spark, d):
    """S16 / Q10 over the files behind each derived source (rows-only: the
    status depends on the wall clock). The genome sources are disabled, as in
    the reference."""
    import datetime as _dt

    from ..sources.freshness import Freshness, source_freshness
    d = d.rstrip("/")
    sources = {
        "raw_movies": Freshness(f"{d}/part.parquet"),
        "raw_ratings": Freshness(f"{d}/lineitem.parquet"),
        "raw_tags": Freshness(f"{d}/events.parquet"),
        "raw_genome_scores": Freshness(f"{d}/lineitem.parquet", None, None),
        "raw_genome_tags": Freshness(f"{d}/supplier.parquet", None, None),
    }
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return source_freshness(spark, sources, now)


def queries() -> dict[str, Query]:
    """Every registered query, in blueprint order."""
    return {
        "daily_rolling": daily_rolling,
        "daily_rolling_dense": daily_rolling_dense,
        "movies_dim": movies_dim,
        "users_dim": users_dim,
        "genome_tags_dim": genome_tags_dim,
        "genome_scores": genome_scores,
        "tag_relevance": tag_relevance,
        "genre_affinity": genre_affinity,
        "genre_top_tags": genre_top_tags,
        "cohort_retention": cohort_retention,
        "ratings_latest": ratings_latest,
        "conditional_update": conditional_update,
        "insert_if_absent": insert_if_absent,
        "delete_where": delete_where,
        "snapshot_history": snapshot_history,
        "snapshot_history_stored": H.stored_history,
        "snapshot_state": snapshot_state,
        "snapshot_withdrawn": snapshot_withdrawn,
        "snapshot_accounting": snapshot_accounting,
        "snapshot_multi_open": snapshot_multi_open,
        "scd2_violations": scd2_violations,
        "scd2_violations_declared": scd2_violations_declared,
        "ratings_incremental": INC.ratings_incremental,
        "incremental_late_rows": INC.incremental_late_rows,
        "incremental_late_rows_lookback": INC.incremental_late_rows_lookback,
        "daily_incremental": INC.daily_incremental,
        "daily_incremental_delete_window": INC.daily_incremental_delete_window,
        "daily_partition_replace": INC.daily_partition_replace,
        "ratings_bucket_merge": INC.ratings_bucket_merge,
        "users_dim_incremental": INC.users_dim_incremental,
        "ratings_from_text": INC.ratings_from_text,
        "ratings_text_rejects": INC.ratings_text_rejects,
        "user_month_bridge": user_month_bridge,
        "retention_approx": retention_approx,
        "retention_sketch_bounds": retention_sketch_bounds,
        "bridge_active_users": bridge_active_users,
        "retention_bridge": retention_bridge,
        "profile_keys": profile_keys,
        "profile_ranges": profile_ranges,
        "profile_ties": profile_ties,
        "profile_vocab": profile_vocab,
        "profile_vocab_reference": profile_vocab_reference,
        "profile_tag_only_users": profile_tag_only_users,
        "profile_years": profile_years,
        "profile_orphans": profile_orphans,
        "check_summary": check_summary,
        "checks_fired": checks_fired,
        "windows_fired": windows_fired,
        "freshness": freshness,
        "freshness_by_source": freshness_by_source,
        "profile_tag_only_users_fired": profile_tag_only_users_fired,
        "profile_orphans_fired": profile_orphans_fired,
        "snapshot_multi_open_fired": snapshot_multi_open_fired,
    }
