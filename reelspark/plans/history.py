"""M15 snap_movies and the history queries R11-R14 over it.

The source extract changes between runs: some films come late (run 2), some
get another genre or a corrected title (run 2), some are withdrawn (run 3)
and reinstated (run 4). The changes are made with the DML rewrites S17-S19
on the whole film table; each selects its rows by a predicate on the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, scd2
from ..operators.dml import conditional_update, delete_where, insert_if_absent
from ..session import configure
from ..sources import testdata

RUNS = tuple(dt.datetime(2024, month, 1) for month in range(1, 5))
LATE_END = "(1965)"                      # films of this year are announced after run 1
REGROUPED, ADDED_GENRE = "%|gear", "hot"  # films listed last under "gear" gain a genre they lack
TITLE_FROM, TITLE_TO = "(1972)", "(1973)"  # a systematic correction
WITHDRAWN_LIKE = "PROMO|%"               # films of this type are gone in run 3

KEY, CHECK_COLS = "movie_id", ("title", "genres")


def source_movies(raw: DataFrame) -> DataFrame:
    """The snapshot reads the source, not a model: rename only."""
    return raw.select(F.col("movieId").alias("movie_id"), "title", "genres")


def reclassify_and_correct(v1: DataFrame) -> DataFrame:
    """Two UPDATEs: append a genre (H16 concat, P10 NOT LIKE), fix a year."""
    g = F.col("genres")
    v = conditional_update(v1, {"genres": F.concat(g, F.lit(f"|{ADDED_GENRE}"))},
                           g.like(REGROUPED) & ~g.like(f"%{ADDED_GENRE}%"))
    return conditional_update(v, {"title": F.replace(F.col("title"), F.lit(TITLE_FROM), F.lit(TITLE_TO))},
                              F.col("title").endswith(TITLE_FROM))


def first_extract(films: DataFrame) -> DataFrame:
    """Run 1: what was announced in time."""
    return delete_where(films, F.col("title").endswith(LATE_END))


def drift(v1: DataFrame, films: DataFrame) -> DataFrame:
    """Run 2: regrouped, corrected, and the late films inserted."""
    return insert_if_absent(reclassify_and_correct(v1), films, [KEY])


def withdraw(v2: DataFrame) -> DataFrame:
    """Run 3."""
    return delete_where(v2, F.col("genres").like(WITHDRAWN_LIKE))


def extracts(spark: SparkSession, d: str, stored: bool = False) -> list[DataFrame]:
    """The film source as it stands at each of the four runs.

    With ``stored`` each drifted extract is written once (the source table
    is changed in place between runs, so each run reads a stored table),
    instead of re-deriving it from the first extract in every job.
    """
    from ..session import materialize
    keep = materialize if stored else (lambda df: df)
    configure(spark)
    films = source_movies(testdata.raw_movies(spark, d))
    v1 = first_extract(films)
    v2 = keep(drift(v1, films))
    v3 = keep(withdraw(v2))
    v4 = keep(insert_if_absent(v3, v2, [KEY]))
    return [v1, v2, v3, v4]


def snap_movies(spark: SparkSession, d: str, n_runs: int = len(RUNS)) -> DataFrame:
    """M15 after the first ``n_runs`` runs (all four by default)."""
    pairs = list(zip(RUNS, extracts(spark, d, stored=True)))[:n_runs]
    # each run's history is stored before the next run reads it
    return scd2.run_sequence(pairs, KEY, CHECK_COLS, store_every=1)


def stored_history(spark: SparkSession, d: str) -> DataFrame:
    """M15 after all runs, each published into the stored history before the next one."""
    import uuid

    from ..session import scratch_path
    from ..sources.tables import FactTable
    from . import fact_build
    table = fact_build.history_table(FactTable.at, spark, scratch_path(spark, f"tables/history-{uuid.uuid4().hex}"))
    for run_ts, extract in zip(RUNS, extracts(spark, d, stored=True)):
        fact_build.merge_history(table, extract, KEY, CHECK_COLS, run_ts).publish()
    return table.read().drop(fact_build.CLOSED_BY)


def snapshot_state(history: DataFrame) -> DataFrame:
    """R11 + O1: every version with its state label, ordered by key then
    version start (an inspection report: the order is part of the output)."""
    return (history.select(
        "movie_id", "title", "genres", "valid_from", "valid_to",
        F.when(F.col("valid_to").isNull(), F.lit("current")).otherwise(F.lit("superseded"))
        .alias("version_state"))
        .orderBy("movie_id", "valid_from"))


def withdrawn_history(history: DataFrame) -> DataFrame:
    """Full history of every key that currently has no open version."""
    open_keys = history.where(F.col("valid_to").isNull()).select("movie_id").distinct()
    return (history.join(open_keys, "movie_id", "left_anti")
            .select("movie_id", "title", "genres", "valid_from", "valid_to"))


def snapshot_accounting(history: DataFrame) -> DataFrame:
    """Total, distinct keys, open, and 'superseded' = total - distinct
    (which, as in the reference, does not count a version closed by a delete
    whose key has no other version)."""
    return history.agg(
        F.count(F.lit(1)).alias("total_versions"),
        F.count_distinct("movie_id").alias("distinct_movies"),
        F.count_if(F.col("valid_to").isNull()).alias("open_versions"),
    ).select("total_versions", "distinct_movies", "open_versions",
             (F.col("total_versions") - F.col("distinct_movies")).alias("superseded_versions"))


def multi_open(history: DataFrame) -> DataFrame:
    """Keys with more than one open version (expected empty)."""
    return (history.where(F.col("valid_to").isNull()).groupBy("movie_id")
            .agg(F.count(F.lit(1)).alias("open_versions"))
            .where(F.col("open_versions") > 1))


def history_violations(history: DataFrame, allow_closed_entities: bool = False,
                       allow_gaps: bool = False) -> DataFrame:
    """Q8 (+ extra mode) over the history, strict by default."""
    return checks.version_violations(history, "movie_id", allow_closed_entities=allow_closed_entities,
                                     allow_gaps=allow_gaps)


# --------------------------------------------------------------- SQL twins

def sql_history_cte(raw_movies_sql: str, n_runs: int = len(RUNS)) -> str:
    """The history without a state: an extract row opens a version when the run before has no equal row of its key,
    and the version lasts until the first later run that has none."""
    runs = ", ".join(f"({i}, TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}')" for i, t in enumerate(RUNS[:n_runs], 1))
    ext = " UNION ALL ".join(f"SELECT {i} AS k, * FROM v{i}" for i in range(1, n_runs + 1))
    same = "p.movie_id = e.movie_id AND p.title IS NOT DISTINCT FROM e.title AND p.genres IS NOT DISTINCT FROM e.genres"
    return f"""
films AS (SELECT movieId AS movie_id, title, genres FROM ({raw_movies_sql})),
v1 AS (SELECT * FROM films WHERE NOT coalesce(ends_with(title, '{LATE_END}'), FALSE)),
v2a AS (
    SELECT movie_id, if(ends_with(title, '{TITLE_FROM}'), replace(title, '{TITLE_FROM}', '{TITLE_TO}'), title) AS title,
        if(genres LIKE '{REGROUPED}' AND NOT contains(genres, '{ADDED_GENRE}'), genres || '|{ADDED_GENRE}', genres) AS genres
    FROM v1),
v2 AS (FROM v2a UNION ALL FROM films WHERE movie_id NOT IN (SELECT movie_id FROM v2a)),
v3 AS (FROM v2 WHERE NOT coalesce(genres LIKE '{WITHDRAWN_LIKE}', FALSE)),
v4 AS (FROM v2),
ext AS ({ext}),
runs AS (SELECT * FROM (VALUES {runs}) r(k, ts)),
opened AS (FROM ext e WHERE NOT EXISTS (FROM ext p WHERE p.k = e.k - 1 AND {same})),
snap_movies AS (
    SELECT e.movie_id, e.title, e.genres,
        md5(concat_ws('|', e.movie_id, epoch_us(r.ts))) AS scd_id, r.ts AS valid_from,
        (SELECT min(x.ts) FROM runs x WHERE x.k > e.k AND NOT EXISTS (FROM ext p WHERE p.k = x.k AND {same})) AS valid_to
    FROM opened e JOIN runs r USING (k))"""


def sql_violations(rel: str, allow_closed_entities: bool = False, allow_gaps: bool = False,
                   extra_mode: bool = True) -> str:
    """Q8 by looking from each version at all the others of its key: the next one is the earliest that starts later,
    and the versions without an end are counted. Each version gets the list of what is wrong with it."""
    closed = "" if allow_closed_entities else " OR n_open = 0"
    modes = [("nxt < valid_to", checks.OVERLAPPING), (f"n_open > 1{closed}", checks.OPEN_COUNT), ("valid_to < valid_from", checks.INVERTED)]
    modes += [] if allow_gaps else [("nxt > valid_to", checks.GAP)]
    modes += [("valid_to IS NULL AND nxt IS NOT NULL", checks.OPEN_SUPERSEDED)] if extra_mode else []
    labels = ", ".join(f"if({when}, '{label}', NULL)" for when, label in modes)
    return f"""
looked AS (
    SELECT a.movie_id AS entity_key, a.valid_from, a.valid_to,
        min(b.valid_from) FILTER (b.valid_from > a.valid_from) AS nxt, count(*) FILTER (b.valid_to IS NULL) AS n_open
    FROM {rel} a JOIN {rel} b ON b.movie_id = a.movie_id GROUP BY ALL),
violations AS (
    SELECT * FROM (SELECT entity_key, valid_from, valid_to, unnest([{labels}]) AS failure_mode FROM looked)
    WHERE failure_mode IS NOT NULL)"""
