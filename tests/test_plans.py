"""Plan hygiene of every registered query (read from ``explain()``):

* no Cartesian product and no nested-loop join,
* no Python evaluation (the build has no UDFs),
* every scan of the large tables prunes columns (never reads all of them).

The corpus operators, which use Arrow tasks, have tests of their own.
"""

import contextlib
import io
import re

import pytest

from .conftest import SF0001

WIDE = {"lineitem": 11, "orders": 6}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


def registered():
    from reelspark.plans import catalog
    return sorted(catalog.queries())


@pytest.mark.parametrize("name", registered())
def test_plan_hygiene(spark, name):
    import __spark_entry__ as E
    text = plan_text(E.queries()[name](spark, SF0001))
    physical = text.split("== Physical Plan ==", 1)[-1]
    for bad in FORBIDDEN:
        assert bad not in physical, f"{name}: {bad} in plan"
    seen = set()
    for table, ncols in WIDE.items():
        for m in re.finditer(rf"FileScan parquet \[([^\]\n]*)\][^\n]*/{table}\.parquet", physical):
            seen.add(table)
            cols = m.group(1).split(",")
            assert len(cols) < ncols, f"{name}: scan of {table} reads all {ncols} columns"
    if name in ("daily_rolling", "ratings_latest", "genome_scores", "users_dim"):
        assert "lineitem" in seen, f"{name}: lineitem scan not found in plan"
