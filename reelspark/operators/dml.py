"""INSERT-if-absent, UPDATE ... WHERE, DELETE ... WHERE as
DataFrame rewrites. Each returns the new relation; publishing it as a new
table version (``sources.tables``) is what makes the change durable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upsert import insert_missing


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... SELECT ... WHERE NOT EXISTS (same key)``."""
    return insert_missing(target, rows, keys)


def conditional_update(df: DataFrame, assignments: Mapping[str, Column], where: Column) -> DataFrame:
    """``UPDATE df SET col = expr WHERE pred``.

    A NULL predicate does not update (``when`` treats it as false). All
    right-hand sides see the old row, as in SQL.
    """
    cols = [F.when(where, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments
            else F.col(c) for c in df.columns]
    return df.select(*cols)


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """``DELETE FROM df WHERE pred`` keeps rows where pred is not TRUE."""
    return df.where(~F.coalesce(pred, F.lit(False)))
