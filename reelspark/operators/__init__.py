"""Relational operators the reference builds by hand: merge upsert, watermark
and lookback filters, SCD2 snapshots, DML-style rewrites, latest row per key,
exact median, and the data-quality check library."""
