"""reelspark: a PySpark analytics layer for user-item rating data.

Layers (each a pure DataFrame -> DataFrame function; only ``sources.tables``
touches storage):

* ``sources``    raw readers, seeds, test-data derivations, versioned tables,
                 source freshness
* ``functions``  Column -> Column helpers (title case, year parse, month diff,
                 exact rounding)
* ``operators``  upsert / high-water mark / lookback, SCD2 snapshot, DML-style
                 rewrites, skew-safe latest-row and exact median, quality checks
* ``plans``      the models: staging, dimensions, facts, marts, profiling,
                 scale variants, and the gated pipeline
* ``streaming``  Structured Streaming wrappers around the incremental upserts

``python -m reelspark build|snapshot|freshness`` runs the gated pipeline over
raw extracts (see ``reelspark.__main__``).
"""

__all__ = ["session"]
