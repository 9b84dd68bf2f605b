"""Cleaning and tokenising a corpus: each stage reads what the one before it kept.

Null, empty and very long texts, repeated rows, null ids and an empty table pass through all stages: a text without
a letter is rejected by the first one; rows without an id are never taken for copies of others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import bpe, decontaminate, language_id, order_minhash, pii
from reelspark.llm.store import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A text of this many characters that is less alike than this to every language's prototype is of none of them
#: (unrelated letters are near 0). A shorter one holds too few n-grams to tell, and stays.
LEAST_LANGUAGE_SCORE, LEAST_CHARACTERS = 0.1, 50


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rejects texts of no known language; a null ``lang`` becomes the prediction."""
    known = language_id.predict(docs, language_id.learn(docs))
    foreign = (F.col("score") < LEAST_LANGUAGE_SCORE) & (F.length("text") >= LEAST_CHARACTERS)
    kept = known.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~foreign)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each class of near copies stays, the one of the smallest id.

    Rows of one id and text are repeated rows, of which one stays; other texts of that id are documents of their own.
    """
    repeated = stored(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        found = stored(order_minhash.classes(docs), "classes")
        dropped = found.where("doc_id <> class_id").select("doc_id").distinct()
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    again = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    once = docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(again)
    # Ids don't tell these rows apart, numbers do; they are written before they are read twice.
    rows = stored(once.withColumn("row_number", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "rows")
    found = order_minhash.classes(rows, "row_number").withColumnRenamed("doc_id", "row_number").where("row_number IS NOT NULL")
    own = rows.where("row_number IS NOT NULL").select("row_number", F.struct("doc_id", F.sha2("text", 256).alias("digest"), "row_number").alias("place"))
    kept = found.join(own, "row_number").groupBy("class_id").agg(F.min("place").alias("least")).select(F.col("least.row_number").alias("row_number"))
    return rows.join(kept, "row_number", "left_semi").unionByName(rows.where("row_number IS NULL")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark window go."""
    marked = decontaminate.mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where("NOT contaminated").select(*docs.columns)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: spans of personal data are replaced by their kind; ``n_chars`` follows the text."""
    found = pii.find(docs, pii.train(docs))
    return found.withColumn("n_chars", F.when(F.col("spans") != "", F.length("redacted_text")).otherwise(F.col("n_chars"))).withColumn("text", F.col("redacted_text")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the ids and their byte offsets, and whether decoding gives the text back."""
    done = bpe.round_trip(docs, RANKS)
    same = F.col("decoded").eqNullSafe(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return done.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "offsets", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", redaction),
    ("byte_bpe", tokens),
]

#: SQL can't express order MinHash, boosted trees and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
