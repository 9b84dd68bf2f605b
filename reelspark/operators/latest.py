"""Latest row per key (I2 de-duplication), skew-safe.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` needs every row of a key
in one task, sorted. ``max(struct(order..., payload...))`` is an ordinary
combinable aggregate: each map task keeps one candidate per key before the
shuffle, so a key holding a third of all rows costs one row per map task.
The order columns must form a total order within a key (ties are then
impossible and the result is deterministic).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row with the greatest ``order`` tuple.

    Returns ``keys + order + payload`` columns (payload defaults to all other
    columns).
    """
    keys, order = list(keys), list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order]
    payload = list(payload)
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"_p{i}") for i, c in enumerate(payload)])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys,
                       *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)],
                       *[F.col(f"_best._p{i}").alias(c) for i, c in enumerate(payload)])
