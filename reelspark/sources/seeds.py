"""Version-controlled seed tables.

A seed is a small reference table kept in the repository (the genre taxonomy).
Its size is fixed by the file, so it is safe to broadcast. Empty cells load as
NULL (``is_fiction`` is null where the question does not apply).
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds")

GENRE_GROUPS_SCHEMA = T.StructType([
    T.StructField("genre", T.StringType(), False),
    T.StructField("genre_group", T.StringType(), True),
    T.StructField("is_fiction", T.BooleanType(), True),
    T.StructField("is_format_not_genre", T.BooleanType(), True),
])

# The reference taxonomy (film genres) and the one for the driver's test
# tables, whose "genres" are part types and part-name words.
GENRE_GROUPS = "genre_groups.csv"
GENRE_GROUPS_TESTDATA = "genre_groups_testdata.csv"


def _parse(value: str, dtype: T.DataType):
    if value == "":
        return None
    if isinstance(dtype, T.BooleanType):
        low = value.strip().lower()
        if low not in ("true", "false"):
            raise ValueError(f"not a boolean: {value!r}")
        return low == "true"
    if isinstance(dtype, T.LongType):
        return int(value)
    if isinstance(dtype, T.DoubleType):
        return float(value)
    return value


def seed_rows(name: str, schema: T.StructType = GENRE_GROUPS_SCHEMA) -> list[tuple]:
    """Parse a packaged seed CSV into typed tuples (header must match schema)."""
    path = name if os.path.isabs(name) else os.path.join(SEED_DIR, name)
    with open(path, newline="", encoding="utf-8") as fh:
        reader = csv.reader(fh)
        header = next(reader)
        if header != schema.fieldNames():
            raise ValueError(f"seed {name}: header {header} != {schema.fieldNames()}")
        rows = [tuple(_parse(v, f.dataType) for v, f in zip(r, schema.fields))
                for r in reader if r]
    return rows


def load_seed(spark: SparkSession, name: str = GENRE_GROUPS,
              schema: T.StructType = GENRE_GROUPS_SCHEMA) -> DataFrame:
    """A packaged seed, as literal rows of the plan: Spark knows its size, and chooses the join by it."""
    return spark.sql(f"SELECT * FROM {seed_values_sql(name, schema)}").select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def read_seed_csv(spark: SparkSession, path: str,
                  schema: T.StructType = GENRE_GROUPS_SCHEMA) -> DataFrame:
    """A seed kept on shared storage instead of in the package."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def seed_values_sql(name: str = GENRE_GROUPS_TESTDATA,
                    schema: T.StructType = GENRE_GROUPS_SCHEMA) -> str:
    """The same seed as a SQL ``VALUES`` relation (used by the SQL oracles)."""
    def lit(v, dtype):
        if v is None:
            return "CAST(NULL AS BOOLEAN)" if isinstance(dtype, T.BooleanType) else "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + str(v).replace("'", "''") + "'"
    body = ",\n    ".join(
        "(" + ", ".join(lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
        for r in seed_rows(name, schema))
    cols = ", ".join(schema.fieldNames())
    return f"(VALUES\n    {body}\n) AS seed({cols})"
