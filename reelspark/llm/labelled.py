"""Labelled rows to learn from, with a bound and a fold that is left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(parts: int) -> F.Column:
    """The fold of a row by its ``doc_id`` as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, label: str, teaches: F.Column, max_rows: int) -> DataFrame:
    """text and label (int) of at most ``max_rows`` different labelled rows that ``teaches`` lets in, those of the
    smallest hashes of their ids; an id that many rows share is cut like any other."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & teaches).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    some = own.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").distinct()
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text"), "text").limit(max_rows).select("text", "label")
