"""Raw-shaped relations derived from the driver's TPC-H-like test tables.

The reference reads film-rating extracts; the test tables are orders and line
items. These functions map one onto the other (see FIXTURES.md, part B) and
return frames with the reference's raw column names, so the staging layer runs
unchanged on them. Every mapping is a projection or an aggregate over the full
tables: the work grows with the tables.

| raw relation      | derived from                                              |
| ----------------- | --------------------------------------------------------- |
| raw_ratings       | lineitem JOIN orders; user = o_custkey, film = l_partkey  |
|                   | (or l_suppkey for the dense variant), rating =            |
|                   | ceil(l_quantity / 5) / 2, time = l_shipdate               |
| raw_tags          | events; tag = event_type, NULL for every 500th event      |
| raw_movies        | part; title and genres built from p_name / p_type         |
| raw_genome_tags   | supplier; tag = lower(s_name)                             |
| raw_genome_scores | lineitem grouped by (part, supplier), max(discount) * 10  |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# --- fixed values of the derivation (FIXTURES.md part B) --------------------
TITLE_NO_YEAR_EVERY = 50        # p_partkey % 50 = 0 -> title without a year
TITLE_MALFORMED_REMAINDER = 1   # p_partkey % 50 = 1 -> "name (yyyy))"
YEAR_BASE, YEAR_SPAN = 1950, 70
NO_GENRES_EVERY = 40            # p_partkey % 40 = 0 -> '(no genres listed)'
NULL_TAG_EVERY = 500            # event_id % 500 = 0 -> NULL tag
RELEVANCE_SCALE = 10            # relevance = max(l_discount) * 10
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_ratings(spark: SparkSession, sf_dir: str, item: str = "part") -> DataFrame:
    """One row per line item: (userId, movieId, rating, timestamp) plus the
    line-item key columns used as a total tie-break order.

    ``timestamp`` keeps the Parquet ``timestamp_ntz`` type; staging converts it
    (epoch seconds, the reference's raw type, go through the same function).
    """
    item_col = {"part": "l_partkey", "supplier": "l_suppkey"}[item]
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
            .select(F.col("o_custkey").alias("userId"),
                    F.col(item_col).alias("movieId"),
                    (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
                    F.col("l_shipdate").alias("timestamp"),
                    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("o_orderdate").cast("timestamp").alias("arrived_at")))


def raw_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").try_cast("long").alias("movieId"),
        F.when(F.col("event_id") % NULL_TAG_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("event_type")).alias("tag"),
        F.col("ts").alias("timestamp"))


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    year = (F.lit(YEAR_BASE) + key % YEAR_SPAN).cast("string")
    title = (F.when(key % TITLE_NO_YEAR_EVERY == 0, F.col("p_name"))
             .when(key % TITLE_NO_YEAR_EVERY == TITLE_MALFORMED_REMAINDER,
                   F.concat(F.col("p_name"), F.lit(" ("), year, F.lit("))")))
             .otherwise(F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")"))))
    genres = (F.when(key % NO_GENRES_EVERY == 0, F.lit("(no genres listed)"))
              .otherwise(F.concat(F.col("p_type"), F.lit("|"),
                                  F.replace(F.col("p_name"), F.lit(" "), F.lit("|")))))
    return p.select(key.alias("movieId"), title.alias("title"), genres.alias("genres"))


def raw_genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("tagId"), F.lower("s_name").alias("tag"))


def raw_genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_partkey").alias("movieId"), F.col("l_suppkey").alias("tagId"))
            .agg((F.max("l_discount") * RELEVANCE_SCALE).alias("relevance")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user universe (parent key set for relationship checks)."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


# --- SQL twins for the DuckDB oracles ---------------------------------------

def sql_raw_ratings(item: str = "part") -> str:
    item_col = {"part": "l_partkey", "supplier": "l_suppkey"}[item]
    return f"""
    SELECT o.o_custkey AS userId, l.{item_col} AS movieId,
           CEIL(l.l_quantity / 5) / 2 AS rating, l.l_shipdate AS "timestamp",
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
           CAST(o.o_orderdate AS TIMESTAMP) AS arrived_at
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


SQL_RAW_TAGS = f"""
    SELECT user_id AS userId,
           TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS movieId,
           CASE WHEN event_id % {NULL_TAG_EVERY} = 0 THEN NULL ELSE event_type END AS tag,
           ts AS "timestamp"
    FROM events"""

SQL_RAW_MOVIES = f"""
    SELECT p_partkey AS movieId,
           CASE WHEN p_partkey % {TITLE_NO_YEAR_EVERY} = 0 THEN p_name
                WHEN p_partkey % {TITLE_NO_YEAR_EVERY} = {TITLE_MALFORMED_REMAINDER}
                     THEN p_name || ' (' || CAST({YEAR_BASE} + p_partkey % {YEAR_SPAN} AS VARCHAR) || '))'
                ELSE p_name || ' (' || CAST({YEAR_BASE} + p_partkey % {YEAR_SPAN} AS VARCHAR) || ')'
           END AS title,
           CASE WHEN p_partkey % {NO_GENRES_EVERY} = 0 THEN '(no genres listed)'
                ELSE p_type || '|' || replace(p_name, ' ', '|') END AS genres
    FROM part"""

SQL_RAW_GENOME_TAGS = "SELECT s_suppkey AS tagId, lower(s_name) AS tag FROM supplier"

SQL_RAW_GENOME_SCORES = f"""
    SELECT l_partkey AS movieId, l_suppkey AS tagId,
           MAX(l_discount) * {RELEVANCE_SCALE} AS relevance
    FROM lineitem GROUP BY l_partkey, l_suppkey"""
