"""Typed source scans.

Locations are arguments, never hard-coded. Schemas are explicit, so no scan
infers types. A CSV extract is bound to the schema by the names in its header,
in any order and with doubled quotes; an extract without one of the columns
raises ``MissingColumnError`` (in either format) instead of giving NULLs.

What a row that does not fit its schema does is the caller's choice: with
``read_source`` it fails the read; ``land`` reads the extract once, keeps the
rows that fit as typed Parquet and the others as they arrived, and fails only
beyond a share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import exists

RAW_MOVIES = T.StructType([
    T.StructField("movieId", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
])
RAW_RATINGS = T.StructType([
    T.StructField("userId", T.LongType(), False),
    T.StructField("movieId", T.LongType(), False),
    T.StructField("rating", T.DoubleType(), False),
    T.StructField("timestamp", T.LongType(), True),
])
RAW_TAGS = T.StructType([
    T.StructField("userId", T.LongType(), False),
    T.StructField("movieId", T.LongType(), False),
    T.StructField("tag", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
])
RAW_GENOME_SCORES = T.StructType([
    T.StructField("movieId", T.LongType(), False),
    T.StructField("tagId", T.LongType(), False),
    T.StructField("relevance", T.DoubleType(), True),
])
RAW_GENOME_TAGS = T.StructType([
    T.StructField("tagId", T.LongType(), False),
    T.StructField("tag", T.StringType(), True),
])

RAW_SCHEMAS = {
    "raw_movies": RAW_MOVIES,
    "raw_ratings": RAW_RATINGS,
    "raw_tags": RAW_TAGS,
    "raw_genome_scores": RAW_GENOME_SCORES,
    "raw_genome_tags": RAW_GENOME_TAGS,
}


class MissingColumnError(ValueError):
    """An extract lacks a column of its schema."""


def read_source(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Scan one source with an explicit schema (parquet or csv); a row that does not fit fails the read."""
    if fmt == "csv":
        found = _csv_schema(spark, path, schema, header)
        return spark.read.schema(found).options(mode="FAILFAST", **_csv_options(header)).csv(path).select(*schema.fieldNames())
    _require(path, schema, spark.read.format(fmt).load(path).columns)
    return spark.read.schema(schema).format(fmt).load(path)


def _csv_options(header: bool) -> dict:
    return {"header": header, "escape": '"', "quote": '"', "enforceSchema": False}


def _csv_schema(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> T.StructType:
    """The columns in the file's order."""
    if not header:
        return schema
    # The header alone tells the order of the columns; all are read as text for that, from the first rows.
    names = spark.read.options(header=True, escape='"', quote='"', inferSchema=False).csv(path).columns
    _require(path, schema, names)
    by_name = {f.name.lower(): f for f in schema.fields}
    return T.StructType([T.StructField(n, by_name[n.lower()].dataType if n.lower() in by_name else T.StringType()) for n in names])


class TooManyRejects(ValueError):
    """More rows of an extract than allowed do not fit its schema."""


@dataclass
class Landed:
    """An extract as it was landed."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejected: int


def land(spark: SparkSession, path: str, schema: T.StructType, target: str, max_rejects: float = 0.0,
         header: bool = True) -> Landed:
    """Reads a CSV extract once into ``target``: typed rows, and beside them the rows that do not fit the schema (of
    another type, or with too few or too many values), each as its ``record`` and the ``file`` it is from.

    The rows are counted as they are written. A share of rejects above ``max_rejects`` raises ``TooManyRejects``; what
    was landed stays for inspection, and an extract lands in a new folder each time.
    """
    if not 0 <= max_rejects <= 1:
        raise ValueError("max_rejects is a share of the rows")
    found = _csv_schema(spark, path, schema, header)
    record = next(n for n in (f"record{'_' * k}" for k in range(1, 9)) if n.lower() not in {x.lower() for x in found.fieldNames()})
    source = (spark.read.schema(T.StructType([*found.fields, T.StructField(record, T.StringType())]))
              .options(mode="PERMISSIVE", columnNameOfCorruptRecord=record, columnPruning=False, **_csv_options(header)).csv(path))
    # without pruning, so that rows of too few or too many values are seen
    bad = F.col(record).isNotNull()
    rows = source.select(F.struct(*(F.when(~bad, F.col(c)).alias(c) for c in schema.fieldNames())).alias("row"),
                         F.col(record).alias("record"), F.when(bad, F.col("_metadata.file_path")).alias("file"), bad.alias("is_reject"))
    seen = Observation()
    (rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("is_reject").alias("bad"))
     .write.partitionBy("is_reject").mode("errorifexists").parquet(target))
    n, n_bad = seen.get["n"], seen.get["bad"]

    def part(flag: str) -> DataFrame:
        at = f"{target}/is_reject={flag}"
        kind = T.StructType([T.StructField("row", schema), T.StructField("record", T.StringType()), T.StructField("file", T.StringType())])
        return spark.read.schema(kind).parquet(at) if exists(spark, at) else spark.createDataFrame([], kind)

    if n and n_bad / n > max_rejects:
        raise TooManyRejects(f"{path}: {n_bad} of {n} rows do not fit their schema (allowed share: {max_rejects}); see {target}")
    return Landed(part("false").select("row.*"), part("true").select("record", "file"), n, n_bad)


def _require(path: str, schema: T.StructType, names: list[str]) -> None:
    there = {n.lower() for n in names}
    if missing := [n for n in schema.fieldNames() if n.lower() not in there]:
        raise MissingColumnError(f"{path} has no column {', '.join(missing)}")


def read_raw(spark: SparkSession, base: str, name: str, fmt: str = "csv") -> DataFrame:
    """Read ``{base}/{name}`` with the schema registered for ``name``."""
    sep = "" if base.endswith("/") else "/"
    return read_source(spark, f"{base}{sep}{name}", RAW_SCHEMAS[name], fmt)
