"""Full build in dependency order, gated by the checks (Q9) and by source
freshness (Q10).

Materialisation per layer, as in the reference:

* staging, fct_genome_scores: views (lazy DataFrames, checked, not stored)
* int_movie_tag_relevance: ephemeral (inlined into its one consumer)
* dimensions, marts, seed: tables (a new version per build, ``sources.tables``)
* fct_ratings, fct_movie_rating_daily: incremental

Write-audit-publish: a table is written as an uncommitted version, its row
checks are counted as it is written, its set checks run against the written
files, and only then is the version committed. Of the two incremental facts
the changed months are staged (``plans.fact_build``), audited, and then take
their place, and the high-water mark moves. A relation whose checks or merge
fail is not published, what was served before stays served, and every relation
that depends on it is skipped; independent branches still build. As the mark
does not move either, the next run meets the same rows and fails again until
they are mended.

The raw sources are checked first, and the film history (snapshot) is part of
a build that is given its run time.

Both facts are stored by month, fct_ratings bucketed by its keys within it. Row
checks of a fact run on the months that the run wrote to, its grain on those
and the rows that share a key with them; relationships run on the whole table,
as a parent may lose a key. Relations that do not need each other are built at
the same time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Check, CheckFailed, Watch, gate, summarize
from ..operators.upsert import DuplicateKeyError, SchemaChangeError
from ..sources.freshness import Freshness, freshness_gate, source_freshness
from ..sources.tables import FactTable, Table
from . import dims, fact_build, facts, marts, staging
from .quality import REFERENCE_GENRE_GROUPS, declared_checks

RATING_BUCKETS = 8
#: Relations that are built at the same time.
BUILD_THREADS = 8

# relation -> (materialisation, upstream relations its build or checks need)
DAG: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_movies": ("source", ()),
    "raw_ratings": ("source", ()),
    "raw_tags": ("source", ()),
    "raw_genome_scores": ("source", ()),
    "raw_genome_tags": ("source", ()),
    "seed_genre_groups": ("table", ()),
    "stg_movies": ("view", ("raw_movies",)),
    "stg_ratings": ("view", ("raw_ratings",)),
    "stg_tags": ("view", ("raw_tags",)),
    "stg_genome_scores": ("view", ("raw_genome_scores",)),
    "stg_genome_tags": ("view", ("raw_genome_tags",)),
    "dim_movies": ("table", ("stg_movies",)),
    "dim_users": ("table", ("stg_ratings", "stg_tags")),
    "dim_genome_tags": ("table", ("stg_genome_tags",)),
    "fct_ratings": ("incremental", ("stg_ratings", "dim_users", "dim_movies")),
    "fct_genome_scores": ("view", ("stg_genome_scores", "dim_movies", "dim_genome_tags")),
    "fct_movie_rating_daily": ("incremental", ("fct_ratings", "dim_movies")),
    "int_movie_tag_relevance": ("ephemeral", ("dim_movies", "fct_genome_scores", "dim_genome_tags")),
    "mart_tag_genre_affinity": ("table", ("int_movie_tag_relevance", "seed_genre_groups")),
    "mart_user_cohort_retention": ("table", ("dim_users", "fct_ratings")),
    "snap_movies": ("snapshot", ("raw_movies",)),
}
#: What a relation can fail of without stopping the others.
FAILURES = (CheckFailed, DuplicateKeyError, SchemaChangeError, fact_build.BucketCountError)


@dataclass
class BuildResult:
    published: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    warnings: list[dict] = field(default_factory=list)
    executed: int = 0  # checks that ran

    @property
    def ok(self) -> bool:
        return not self.failed and not self.skipped


@dataclass
class Made:
    """What became of one relation."""
    rows: DataFrame | None = None
    version: str | None = None
    failed: str | None = None
    skipped: bool = False
    warnings: list[dict] = field(default_factory=list)
    executed: int = 0

    @property
    def blocks(self) -> bool:
        return self.skipped or self.failed is not None


class Pipeline:
    """Builds the models from raw source DataFrames into ``{base}/{namespace}``."""

    def __init__(self, spark: SparkSession, base: str, namespace: str,
                 raw: Mapping[str, DataFrame], genre_groups: DataFrame,
                 checks: dict[str, list[Check]] | None = None,
                 freshness: Mapping[str, Freshness] | None = None,
                 accepted_genre_groups: tuple[str, ...] = REFERENCE_GENRE_GROUPS,
                 rating_buckets: int = RATING_BUCKETS):
        """``rating_buckets``: key buckets of a month of fct_ratings, sized so
        that a bucket of a month is a file of 128 MB or more. Fixed for the life
        of the table: changing it needs a full refresh."""
        self.spark, self.base, self.namespace = spark, base, namespace
        self.rating_buckets = rating_buckets
        self.raw = dict(raw)
        self.genre_groups = genre_groups
        self.checks = checks if checks is not None else declared_checks(accepted_genre_groups)
        self.freshness = freshness

    # --------------------------------------------------------------- storage
    def table(self, name: str) -> Table:
        return Table(self.spark, self.base, name, self.namespace)

    def fact(self, name: str) -> FactTable:
        kind = fact_build.ratings_table if name == "fct_ratings" else fact_build.daily_table
        return kind(FactTable, self.spark, self.base, name, self.namespace)

    # ----------------------------------------------------------------- build
    def _build(self, name: str, t: dict[str, DataFrame]) -> DataFrame:
        r = self.raw
        if name == "seed_genre_groups":
            return self.genre_groups
        if name == "stg_movies":
            return staging.stg_movies(r["raw_movies"])
        if name == "stg_ratings":
            return staging.stg_ratings(r["raw_ratings"])
        if name == "stg_tags":
            return staging.stg_tags(r["raw_tags"])
        if name == "stg_genome_scores":
            return staging.stg_genome_scores(r["raw_genome_scores"])
        if name == "stg_genome_tags":
            return staging.stg_genome_tags(r["raw_genome_tags"])
        if name == "dim_movies":
            return dims.dim_movies(t["stg_movies"])
        if name == "dim_users":
            return dims.dim_users(t["stg_ratings"], t["stg_tags"])
        if name == "dim_genome_tags":
            return dims.dim_genome_tags(t["stg_genome_tags"])
        if name == "fct_genome_scores":
            return facts.fct_genome_scores(t["stg_genome_scores"])
        if name == "int_movie_tag_relevance":
            return marts.int_movie_tag_relevance(t["dim_movies"], t["fct_genome_scores"],
                                                 t["dim_genome_tags"])
        if name == "mart_tag_genre_affinity":
            return marts.mart_tag_genre_affinity(t["int_movie_tag_relevance"], t["seed_genre_groups"])
        if name == "mart_user_cohort_retention":
            return marts.mart_user_cohort_retention(t["dim_users"], t["fct_ratings"])
        raise KeyError(name)

    def _merged(self, name: str, t: dict[str, DataFrame], full_refresh: bool, watch: Watch) -> fact_build.Candidate:
        tbl = self.fact(name)
        if name == "fct_movie_rating_daily":
            return fact_build.merge_daily(tbl, t["fct_ratings"], full_refresh, watch=watch)
        since = None if full_refresh or not tbl.exists() else fact_build.stored_mark(tbl)
        return fact_build.merge_ratings(tbl, staging.stg_ratings(self.raw["raw_ratings"], since_us=since),
                                        self.rating_buckets, full_refresh, watch=watch)

    # ------------------------------------------------------------------- run
    def run(self, full_refresh: bool = False, now: dt.datetime | None = None, threads: int = BUILD_THREADS) -> BuildResult:
        """Build every relation after those it needs, independent ones at the
        same time in up to ``threads`` threads; ``now`` (UTC) is the freshness
        clock and the run time of the film history. The result does not depend
        on ``threads``."""
        res = BuildResult()
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if self.freshness:
            report = source_freshness(self.spark, self.freshness, now)
            res.warnings.extend(freshness_gate(report))
        t: dict[str, DataFrame] = dict(self.raw)
        made: dict[str, Made] = {}
        broken: dict[str, BaseException] = {}

        def relation(name: str) -> Made:
            # in FAIR mode each relation's jobs get their share
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return self._make(name, dict(t), full_refresh, now)

        with ThreadPoolExecutor(max_workers=threads) as pool:
            running: dict[Future, str] = {}
            while True:
                for name, (_, deps) in DAG.items():
                    if name in made or name in running.values() or broken or any(d not in made for d in deps):
                        continue
                    if any(made[d].blocks for d in deps):
                        made[name] = Made(skipped=True)
                    else:
                        running[pool.submit(inheritable_thread_target(self.spark)(relation), name)] = name
                if not running:
                    if broken or len(made) == len(DAG):
                        break
                    continue  # what was skipped may let others be skipped
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for f in done:
                    name = running.pop(f)
                    if f.exception() is not None:
                        broken[name] = f.exception()
                    else:
                        made[name] = f.result()
                        if made[name].rows is not None:
                            t[name] = made[name].rows
        if broken:  # not a failed check but an error: nothing more is started
            raise broken[min(broken, key=list(DAG).index)]
        for name in DAG:
            m = made[name]
            res.warnings.extend(m.warnings)
            res.executed += m.executed
            if m.skipped:
                res.skipped.append(name)
            elif m.failed is not None:
                res.failed[name] = m.failed
            elif m.version is not None:
                res.published[name] = m.version
        return res

    def _make(self, name: str, t: dict[str, DataFrame], full_refresh: bool, now: dt.datetime) -> Made:
        """Builds, audits and publishes one relation."""
        mat, out = DAG[name][0], Made()
        cs = self.checks.get(name, [])
        out.executed = len(cs)
        watch = Watch(cs) if mat in ("incremental", "table") else None
        written: fact_build.Candidate | str | None = None
        try:
            if mat == "incremental":
                written = self._merged(name, t, full_refresh, watch)
                self._audit(name, out, {"unique_combination": written.related(), "unique": written.related(),
                                        "relationships": written.whole()}, written.changed(), t, watch)
                written.publish()
                out.version, out.rows = written.table.current()["version"], written.table.read()
            elif mat == "source":
                self._audit(name, out, {}, t[name], t)
            elif mat == "snapshot":
                out.version = self.snapshot_movies(now)
            elif mat == "table":
                tbl = self.table(name)
                written = tbl.stage(watch.on(self._build(name, t)))
                out.rows = tbl.read(written)
                self._audit(name, out, {}, out.rows, t, watch)
                tbl.commit(written)
                out.version = written
            else:
                out.rows = self._build(name, t)
                self._audit(name, out, {}, out.rows, t)
        except FAILURES as e:
            out.failed = str(e)
            if isinstance(written, str):
                self.table(name).discard(written)
            elif written is not None:
                written.discard()
        return out

    def history(self) -> FactTable:
        """The film history, by the run that closed a version."""
        return fact_build.history_table(FactTable, self.spark, self.base, "snap_movies", self.namespace)

    def snapshot_movies(self, run_ts: dt.datetime) -> str:
        """One snapshot run of the raw film source into the stored
        history, audited (Q8 and the column checks) before it is published:
        the versions of the films that the run changes or keeps open."""
        tbl, cs = self.history(), self.checks.get("snap_movies", [])
        src = self.raw["raw_movies"].select(F.col("movieId").alias("movie_id"), "title", "genres")
        watch = Watch(cs)
        made = fact_build.merge_history(tbl, src, "movie_id", ("title", "genres"), run_ts, watch)
        try:
            rest = summarize("snap_movies", made.related(), [c for c in cs if not c.is_row_check], {})
            gate(rest, {c.name: c for c in cs}, watch.summary("snap_movies"))
        except CheckFailed:
            made.discard()
            raise
        made.publish()
        return tbl.current()["version"]

    def _audit(self, name: str, out: Made, scopes: Mapping[str, DataFrame], df: DataFrame, t: dict[str, DataFrame],
               watch: Watch | None = None) -> None:
        """Gates a relation: row checks by what ``watch`` counted while it was written (views are read for them), the
        others on the rows they ask for (by kind in ``scopes``, or ``df``)."""
        cs = self.checks.get(name, [])
        seen = watch.summary(name) if watch else []
        parts = [summarize(name, scopes.get(kind, df), [c for c in own if not (watch and c.is_row_check)], t)
                 for kind, own in _by_scope(cs, scopes).items()]
        parts = [p for p in parts if p is not None]
        summary = reduce(DataFrame.unionByName, parts) if parts else None
        out.warnings = gate(summary, {c.name: c for c in cs}, seen)


def _by_scope(checks: list[Check], scopes: Mapping[str, DataFrame]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for c in checks:
        out.setdefault(c.kind if c.kind in scopes else "", []).append(c)
    return out
