"""Q1-Q8: data-quality checks. A check is a query returning violating rows;
zero rows = pass.

Row checks (not_null, accepted_values, between, expression_is_true) are a
violation predicate per row; set checks look at keys (unique,
unique_combination, relationships) or at windows (no_overlapping_versions).
``summarize_all`` counts the row and key checks of any number of relations in
one aggregate; ``Watch`` counts row checks while a relation is written.

NULL handling follows the public documentation of the originating packages:
a NULL makes a between / accepted_values / expression predicate unknown, and
unknown is not a violation; a NULL child key passes a relationships check;
unique ignores NULLs; unique_combination groups NULLs like values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check on one relation."""
    kind: str
    name: str
    # Row checks: violation predicate. Set checks: (df, tables) -> violations.
    predicate: Callable[[], Column] | None = None
    query: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame] | None = None
    severity: str = "error"
    params: dict = field(default_factory=dict, hash=False, compare=False)
    # Set checks whose violation rows are pre-aggregated: the column holding
    # how many underlying rows each violation row stands for.
    weight: str | None = None

    @property
    def is_row_check(self) -> bool:
        return self.predicate is not None


# ------------------------------------------------------------------ row checks

def not_null(col: str) -> Check:
    """Q1."""
    return Check("not_null", f"not_null({col})", predicate=lambda: F.col(col).isNull(),
                 params={"col": col})


def accepted_values(col: str, values: Sequence) -> Check:
    """Q5: value outside the list (NULL passes)."""
    vals = list(values)
    return Check("accepted_values", f"accepted_values({col})",
                 predicate=lambda: ~F.col(col).isin(vals), params={"col": col, "values": vals})


def between(col: str, min_value=None, max_value=None, row_condition: str | None = None) -> Check:
    """Q6: inclusive range, either bound optional, optional row condition."""
    if min_value is None and max_value is None:
        raise ValueError("between needs a bound")

    def pred() -> Column:
        c = F.col(col)
        ok = F.lit(True)
        if min_value is not None:
            ok = ok & (c >= F.lit(min_value))
        if max_value is not None:
            ok = ok & (c <= F.lit(max_value))
        bad = ~ok
        return F.expr(row_condition) & bad if row_condition else bad
    return Check("between", f"between({col},{min_value},{max_value})", predicate=pred,
                 params={"col": col, "min": min_value, "max": max_value,
                         "row_condition": row_condition})


def expression_is_true(col: str, expression: str) -> Check:
    """Q7: ``NOT (col <expression>)``, e.g. ``n_ratings_28d >= n_ratings_7d``."""
    text = f"{col} {expression}"
    return Check("expression_is_true", f"expression_is_true({text})",
                 predicate=lambda: ~F.expr(text), params={"expression": text})


# ------------------------------------------------------------------ set checks

def unique(col: str) -> Check:
    """Q2: values occurring more than once (NULLs ignored)."""
    def q(df, _):
        return (df.where(F.col(col).isNotNull()).groupBy(col)
                .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))
    return Check("unique", f"unique({col})", query=q, params={"col": col})


def unique_combination(cols: Sequence[str]) -> Check:
    """Q3: combinations occurring more than once."""
    cols = list(cols)

    def q(df, _):
        return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    return Check("unique_combination", f"unique_combination({','.join(cols)})", query=q,
                 params={"cols": cols})


def relationships(col: str, to: str, field_name: str) -> Check:
    """Q4: non-NULL child keys missing from the parent relation ``to``.

    Returns one row per missing key with its number of child rows
    (``n_records``); the violation count is the number of child rows. Both
    sides are reduced to distinct keys before the anti-join (combinable
    aggregates), so a key holding a third of the child rows is one row in
    the join, not a skewed partition.
    """
    def q(df, tables):
        parent = tables[to].select(F.col(field_name).alias("_parent_key")).distinct()
        child = (df.where(F.col(col).isNotNull()).groupBy(col)
                 .agg(F.count(F.lit(1)).alias("n_records")))
        return child.join(parent, child[col] == parent["_parent_key"], "left_anti")
    return Check("relationships", f"relationships({col}->{to}.{field_name})", query=q,
                 params={"col": col, "to": to, "field": field_name}, weight="n_records")


# Failure modes of the SCD2 coherence check (Q8a-d) plus the extra mode for
# an open version followed by another version, which the four miss.
OVERLAPPING = "overlapping_windows"
GAP = "gap_between_versions"
OPEN_COUNT = "invalid_open_version_count"
INVERTED = "valid_to_before_valid_from"
OPEN_SUPERSEDED = "open_window_superseded"


def version_violations(df: DataFrame, entity_key: str, valid_from: str = "valid_from",
                       valid_to: str = "valid_to", allow_closed_entities: bool = False,
                       allow_gaps: bool = False, extra_mode: bool = True) -> DataFrame:
    """Q8: one row per (version, failure mode).

    LEAD and the open-version count share one window partitioning (the
    entity); the labelled branches are produced in one pass by exploding an
    array of (mode or NULL) instead of a UNION ALL of five scans.
    """
    w = Window.partitionBy(entity_key)
    v = df.select(
        F.col(entity_key).alias("entity_key"), F.col(valid_from).alias("valid_from"),
        F.col(valid_to).alias("valid_to"),
        F.lead(valid_from).over(w.orderBy(valid_from)).alias("next_valid_from"),
        F.sum(F.when(F.col(valid_to).isNull(), 1).otherwise(0)).over(w).alias("open_version_count"))
    nxt, vt, vf, n_open = (F.col("next_valid_from"), F.col("valid_to"), F.col("valid_from"),
                           F.col("open_version_count"))
    modes = [F.when(nxt.isNotNull() & (vt > nxt), F.lit(OVERLAPPING))]
    if not allow_gaps:
        modes.append(F.when(nxt.isNotNull() & (vt < nxt), F.lit(GAP)))
    bad_open = n_open > 1
    if not allow_closed_entities:
        bad_open = bad_open | (n_open == 0)
    modes.append(F.when(bad_open, F.lit(OPEN_COUNT)))
    modes.append(F.when(vt.isNotNull() & (vt < vf), F.lit(INVERTED)))
    if extra_mode:
        modes.append(F.when(nxt.isNotNull() & vt.isNull(), F.lit(OPEN_SUPERSEDED)))
    return (v.select("entity_key", "valid_from", "valid_to",
                     F.explode(F.array(*modes)).alias("failure_mode"))
            .where(F.col("failure_mode").isNotNull()))


def no_overlapping_versions(entity_key: str, valid_from: str = "valid_from",
                            valid_to: str = "valid_to", allow_closed_entities: bool = False,
                            allow_gaps: bool = False, extra_mode: bool = False,
                            extra_only: bool = False) -> Check:
    """Q8 as declared (four modes); ``extra_only`` checks just the fifth mode."""
    def q(df, _):
        v = version_violations(df, entity_key, valid_from, valid_to, allow_closed_entities,
                               allow_gaps, extra_mode or extra_only)
        if extra_only:
            v = v.where(F.col("failure_mode") == OPEN_SUPERSEDED)
        return v
    name = "open_window_superseded" if extra_only else "no_overlapping_versions"
    return Check(name, f"{name}({entity_key})", query=q,
                 params={"entity_key": entity_key, "valid_from": valid_from, "valid_to": valid_to,
                         "allow_closed_entities": allow_closed_entities, "allow_gaps": allow_gaps,
                         "extra_mode": extra_mode, "extra_only": extra_only})


# ------------------------------------------------------------------- running

def violations(check: Check, df: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The violating rows of one check (what a stored-failures table holds)."""
    if check.is_row_check:
        return df.where(check.predicate())
    return check.query(df, tables or {})


def _keys(c: Check) -> list[str] | None:
    """Key columns of a grain check (unique / unique_combination) or of a child in a relationship."""
    if c.kind in ("unique", "relationships"):
        return [c.params["col"]]
    return list(c.params["cols"]) if c.kind == "unique_combination" else None


def _key(cols: Sequence[str]) -> Column:
    """Key values in one form for all relations: equal keys, and only those, are equal in it."""
    return F.array(*(F.col(c).cast("string") for c in cols))


def summarize(relation: str, df: DataFrame, checks: Sequence[Check],
              tables: Mapping[str, DataFrame] | None = None) -> DataFrame | None:
    """(relation, check, kind, n_violations) for every check of a relation; None if there is none."""
    return summarize_all({relation: (df, checks)}, tables)


def summarize_all(relations: Mapping[str, tuple[DataFrame, Sequence[Check]]],
                  tables: Mapping[str, DataFrame] | None = None) -> DataFrame | None:
    """(relation, check, kind, n_violations) for every check of every relation, in one aggregate; None if there is none.

    Every relation is read once for all its checks: a row becomes one entry for each key check (its key under the
    check's number), as GROUPING SETS would make, and one, without a key, for each row check that it breaks. A
    relationship's parent adds its own keys to the child's. The entries of all relations are added up by (check, key),
    combined before the one shuffle, so a key that a third of the rows share is one entry per task; a grain check counts
    the keys of several rows, a relationship the rows of keys without a parent, a row check its entries. Version checks
    (a window each) come beside.
    """
    tables = tables or {}
    meta: list[tuple[int, str, str, str]] = []      # number, relation, check, kind
    branches: list[DataFrame] = []
    apart: list[DataFrame] = []
    parents: dict[tuple[str, str], list[int]] = {}
    numbers: dict[str, list[int]] = {"row": [], "unique": [], "relationships": []}
    entry = lambda number, key, n, parent: F.struct(
        F.lit(number).alias("number"), key.alias("key"), n.cast("long").alias("n"), F.lit(parent).alias("parent"))
    each = lambda df, entries: df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")
    no_key = F.array().cast("array<string>")
    for name, (df, cs) in relations.items():
        broken, entries = [], []
        for c in (c for c in cs if c.is_row_check or _keys(c) is not None):
            number = len(meta)
            meta.append((number, name, c.name, c.kind))
            numbers.setdefault("row" if c.is_row_check else c.kind, []).append(number)
            if c.is_row_check:
                broken.append(F.coalesce(c.predicate(), F.lit(False)))
                entries.append(F.when(broken[-1], entry(number, no_key, F.lit(1), False)))
                continue
            if c.kind == "relationships":
                parents.setdefault((c.params["to"], c.params["field"]), []).append(number)
            present = F.when(F.col(c.params["col"]).isNotNull(), 1).otherwise(0) if c.kind == "relationships" else F.lit(1)
            entries.append(entry(number, _key(_keys(c)), present, False))
        if entries:
            branches.append(each(df.where(reduce(Column.__or__, broken)) if len(broken) == len(entries) else df, entries))
        apart += _version_counts(name, df, [c for c in cs if not c.is_row_check and _keys(c) is None], tables)
    for (to, col), own in parents.items():
        branches.append(each(tables[to].where(F.col(col).isNotNull()), [entry(n, _key([col]), F.lit(0), True) for n in own]))
    parts = list(apart)
    if branches:
        of = lambda kind: F.col("number").isin(numbers[kind]) if numbers[kind] else F.lit(False)
        added = reduce(DataFrame.unionByName, branches).groupBy("number", "key").agg(F.sum("n").alias("n"), F.bool_or("parent").alias("parent"))
        ignored = of("unique") & F.get("key", F.lit(0)).isNull()
        broken = (F.when(of("row"), F.col("n")).when(of("relationships"), F.when(~F.col("parent"), F.col("n")).otherwise(0))
                  .otherwise(F.when((F.col("n") > 1) & ~ignored, 1).otherwise(0)))
        found = added.groupBy("number").agg(F.sum(broken).alias("x"))
        known = branches[0].sparkSession.createDataFrame(meta, "number int, relation string, check string, kind string")
        parts.append(known.join(found, "number", "left").select("relation", "check", "kind", F.coalesce("x", F.lit(0)).cast("long").alias("n_violations")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _version_counts(relation: str, df: DataFrame, checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The counts of checks that need a window; checks of the same versions share it."""
    groups: dict[tuple, list[Check]] = {}
    for c in checks:
        groups.setdefault(tuple(c.params[k] for k in ("entity_key", "valid_from", "valid_to")), []).append(c)
    out = []
    for (key, valid_from, valid_to), own in groups.items():
        # The modes a check is not asked for are left out of its count.
        loose = lambda name: all(c.params[name] or c.params["extra_only"] for c in own)  # noqa: B023, E731
        found = version_violations(df, key, valid_from, valid_to, loose("allow_closed_entities"), loose("allow_gaps"))
        counts = found.groupBy().agg(*(F.count_if(_counted(c)).alias(f"c{i}") for i, c in enumerate(own)))
        if any(c.params["allow_closed_entities"] and not loose("allow_closed_entities") and not c.params["extra_only"] for c in own):
            raise ValueError(f"{relation}: version checks of one key ask for closed entities in two ways")
        out.append(counts.select(F.explode(F.array(*(F.struct(F.lit(relation).alias("relation"), F.lit(c.name).alias("check"), F.lit(c.kind).alias("kind"),
                                                                  F.col(f"c{i}").alias("n_violations")) for i, c in enumerate(own)))).alias("s")).select("s.*"))
    return out


def _counted(c: Check) -> Column:
    """Which violations of the shared pass are this check's."""
    mode = F.col("failure_mode")
    if c.params["extra_only"]:
        return mode == OPEN_SUPERSEDED
    wanted = mode != OPEN_SUPERSEDED if not c.params["extra_mode"] else F.lit(True)
    return wanted & (mode != GAP) if c.params["allow_gaps"] else wanted


class Watch:
    """Row checks (and other aggregates) counted while a relation is written, so that no file is read again for them.

    The counts are observed where the rows are written, after the last shuffle. A task that is run again there counts
    once; a count is 0 exactly when no row breaks the check.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.is_row_check]
        self._observed = Observation()
        self._columns = [F.coalesce(F.count_if(F.coalesce(c.predicate(), F.lit(False))), F.lit(0)).cast("long").alias(f"_r{i}")
                         for i, c in enumerate(self.checks)]

    def also(self, name: str, aggregate: Column) -> None:
        """One more aggregate, for ``value``."""
        self._columns.append(aggregate.alias(name))

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observed, *self._columns) if self._columns else df

    def value(self, name: str):
        """An aggregate of the rows that were written (waits for the write)."""
        return self._observed.get[name]

    def summary(self, relation: str) -> list[dict]:
        """What ``summarize`` gives for the row checks, as rows on the driver (one per check)."""
        return [{"relation": relation, "check": c.name, "kind": c.kind, "n_violations": self.value(f"_r{i}")}
                for i, c in enumerate(self.checks)]


class CheckFailed(RuntimeError):
    """Q9: a gate found violations of error-severity checks."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        names = ", ".join(f"{f['relation']}:{f['check']}={f['n_violations']}" for f in failures)
        super().__init__(f"data-quality checks failed: {names}")


def gate(summary: DataFrame | None, checks_by_name: Mapping[str, Check] | None = None,
         observed: Sequence[dict] = ()) -> list[dict]:
    """Q9: raise if any error-severity check has violations; return warnings.

    Only the per-check summary (one row per declared check) reaches the
    driver; ``observed`` are rows that a ``Watch`` has counted already.
    """
    rows = [r for r in observed if r["n_violations"] > 0]
    if summary is not None:
        rows += [r.asDict() for r in summary.where(F.col("n_violations") > 0).collect()]
    sev = {k: c.severity for k, c in (checks_by_name or {}).items()}
    errors = [r for r in rows if sev.get(r["check"], "error") == "error"]
    if errors:
        raise CheckFailed(errors)
    return rows
