"""Q1-Q9: every check with a passing and a failing fixture."""

import datetime as dt

import pytest

from reelspark.operators import checks as C


def count(check, df, tables=None):
    return C.violations(check, df, tables).count()


def test_row_checks(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 5, 3), (None, 6.0, "z", 1, 3), (3, None, None, None, 1)],
                               "id long, r double, g string, n28 long, n7 long")
    assert count(C.not_null("id"), df) == 1
    assert count(C.not_null("g"), df) == 1
    assert count(C.accepted_values("g", ["a", "b"]), df) == 1        # NULL passes
    assert count(C.between("r", 0.5, 5.0), df) == 1                  # NULL passes
    assert count(C.between("r", 0.5), df) == 0                       # min only
    assert count(C.between("r", None, 5.0, "id is not null"), df) == 0  # row_condition
    assert count(C.expression_is_true("n28", ">= n7"), df) == 1      # NULL passes
    summary = {r.check: r.n_violations for r in C.summarize("t", df, [
        C.not_null("id"), C.between("r", 0.5, 5.0), C.unique("g")]).collect()}
    assert summary == {"not_null(id)": 1, "between(r,0.5,5.0)": 1, "unique(g)": 0}


def test_set_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 3), (None, 4)], "a long, b long")
    assert count(C.unique("a"), df) == 1                             # NULLs ignored
    assert count(C.unique_combination(["a", "b"]), df) == 1
    parent = spark.createDataFrame([(1,)], "a long")
    rel = C.relationships("a", "parent", "a")
    v = C.violations(rel, df, {"parent": parent}).collect()
    assert [(r.a, r.n_records) for r in v] == [(2, 1)]               # only a=2; NULL child passes
    big = spark.createDataFrame([(7,)] * 5 + [(1,)], "a long")
    s = C.summarize("t", big, [rel], {"parent": parent}).collect()[0]
    assert s.n_violations == 5                                       # child rows, not keys


def V(day):
    return dt.datetime(2024, 1, day) if day else None


def histories(spark, rows):
    return spark.createDataFrame([(k, V(f), V(t)) for k, f, t in rows],
                                 "k long, valid_from timestamp, valid_to timestamp")


@pytest.mark.parametrize("rows,mode", [
    ([(1, 1, 5), (1, 3, None)], C.OVERLAPPING),
    ([(1, 1, 3), (1, 5, None)], C.GAP),
    ([(1, 1, None), (1, 3, None)], C.OPEN_COUNT),
    ([(1, 1, 3)], C.OPEN_COUNT),
    ([(1, 5, 3), (1, 6, None)], C.INVERTED),
])
def test_q8_modes(spark, rows, mode):
    modes = {r.failure_mode for r in C.version_violations(histories(spark, rows), "k").collect()}
    assert mode in modes


def test_q8_flags_and_open_then_closed(spark):
    closed = histories(spark, [(1, 1, 3)])
    assert C.version_violations(closed, "k", allow_closed_entities=True).count() == 0
    gap = histories(spark, [(1, 1, 3), (1, 5, None)])
    assert C.version_violations(gap, "k", allow_gaps=True).count() == 0
    # open window followed by a closed one: the four modes miss it
    blind = histories(spark, [(1, 1, None), (1, 5, 9)])
    four = C.version_violations(blind, "k", extra_mode=False)
    assert four.count() == 0
    extra = {r.failure_mode for r in C.version_violations(blind, "k").collect()}
    assert extra == {C.OPEN_SUPERSEDED}
    clean = histories(spark, [(1, 1, 3), (1, 3, None), (2, 2, None)])
    assert C.version_violations(clean, "k").count() == 0


def test_q9_gate_raises_on_error_checks(spark):
    df = spark.createDataFrame([(None,)], "id long")
    s = C.summarize("t", df, [C.not_null("id")])
    with pytest.raises(C.CheckFailed):
        C.gate(s)
    ok = spark.createDataFrame([(1,)], "id long")
    assert C.gate(C.summarize("t", ok, [C.not_null("id")])) == []


def test_declared_check_count():
    from reelspark.plans.quality import declared_checks
    n = sum(len(v) for v in declared_checks(include_extra=False).values())
    assert n == 106


def test_row_checks_do_not_widen_the_key_entries(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, "a", 9.0), (2, "b", None), (None, "c", 7.0)], "k long, s string, x double")
    cs = [C.not_null("k"), C.unique("k"), C.not_null("s"), C.between("x", 0, 5), C.not_null("x")]
    found = C.summarize_all({"keyed": (df, cs), "rows": (df, [c for c in cs if c.is_row_check])})
    assert {(r.relation, r.check): r.n_violations for r in found.collect()} == {
        ("keyed", "not_null(k)"): 1, ("keyed", "unique(k)"): 1, ("keyed", "not_null(s)"): 1, ("keyed", "between(x,0,5)"): 2, ("keyed", "not_null(x)"): 1,
        ("rows", "not_null(k)"): 1, ("rows", "not_null(s)"): 1, ("rows", "between(x,0,5)"): 2, ("rows", "not_null(x)"): 1}
    assert "sum(v" not in found._jdf.queryExecution().optimizedPlan().toString()
