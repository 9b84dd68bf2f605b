"""Language identification with hyperdimensional profiles.

Each letter class has a random vector of +1 and -1. An n-gram's vector is the product of its letters' vectors, each
rotated by its place (binding by permutation). A text's vector is the sum of its n-grams' vectors (bundling), and a
language's prototype is the sum over its training texts. The prediction is the prototype of the largest cosine.

Vectors are made only for the n-grams that a slice of rows holds: the sum over a text is its counts of n-grams times
those vectors, one matrix product for a slice. Training sums over all training texts; what tasks send is one
vector for each language, summed by Spark by (language, place).

Defined cases: a null text, an empty one, or one without a letter gets ``und`` and 0; so does every text when nothing
was learned, and a text whose letters make no n-gram with a positive cosine gets the nearest language and 0. A null
doc_id is in no fold: it is not held out, and teaches. Rows
with a null language are predicted but teach nothing. Repeated rows count as often as they occur; ties go to the
first language in order of name. Other columns are carried along; ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm import bpe
from reelspark.llm.arrow_text import code_points, passes, text_bytes
from reelspark.llm.store import task_session

DIMENSIONS = 1024
NGRAM = 3
UNDETERMINED = "und"
#: Classes of letters: 0 is all that is no letter, then a to z, then all other letters by their code point.
CLASSES = 64
#: Prototypes are sent to the tasks; more languages than this are refused.
MAX_LANGUAGES = 4096
#: Entries of a table of counts (rows x n-grams) at most, in one pass over a slice of rows.
CELLS = 1 << 22
_SEED = 20


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """The class of every code point, both cases alike."""
    point = np.arange(0x110000)
    low = point.copy()
    for c in range(0x10000):
        small = chr(c).lower()
        if len(small) == 1:
            low[c] = ord(small)
    kind = 27 + low % (CLASSES - 27)
    kind = np.where((low >= 97) & (low <= 122), low - 96, kind)
    return np.where(bpe.class_table() == bpe.LETTER, kind, 0).astype(np.int32)


@lru_cache(maxsize=4)
def rotated_letters(dimensions: int) -> np.ndarray:
    """For each place in an n-gram, the letters' vectors rotated by it."""
    letters = np.random.default_rng(_SEED).choice(np.array([-1, 1], np.float32), (CLASSES, dimensions))
    return np.stack([np.roll(letters, NGRAM - 1 - place, axis=1) for place in range(NGRAM)])


def ngrams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row and the code of every n-gram, in order, and whether each row has a letter."""
    points, where = code_points(raw)
    kind = letter_classes()[points]
    rows = len(at) - 1
    row = np.searchsorted(at, where, "right") - 1
    lettered = np.bincount(row[kind > 0], minlength=rows) > 0
    n = len(kind) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), lettered
    code = np.zeros(n, np.int64)
    for place in range(NGRAM):
        code = code * CLASSES + kind[place : place + n]
    valid = (row[:n] == row[NGRAM - 1 :]) & (code > 0)
    return row[:n][valid], code[valid], lettered


def count_slices(row: np.ndarray, code: np.ndarray, rows: int, cells: int = CELLS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of the rows (first, last) with the n-grams they hold and how often each row has each, such that no table
    of counts has more than ``cells`` entries (one row at least)."""
    open_slices = [(0, rows)] if rows else []
    while open_slices:
        first, last = open_slices.pop()
        a, b = np.searchsorted(row, [first, last])
        seen = np.zeros(CLASSES**NGRAM, bool)
        seen[code[a:b]] = True
        grams = np.flatnonzero(seen)
        if (last - first) * len(grams) > cells and last - first > 1:
            middle = (first + last) // 2
            open_slices += [(middle, last), (first, middle)]
            continue
        dense = np.zeros(CLASSES**NGRAM, np.int64)
        dense[grams] = np.arange(len(grams))
        size = (last - first) * len(grams)
        counts = np.bincount((row[a:b] - first) * len(grams) + dense[code[a:b]], minlength=size) if size else np.zeros(0)
        yield first, last, grams, counts.reshape(last - first, len(grams)).astype(np.float32)


def ngram_counts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of all rows, how often each row has each, and whether each row has a letter."""
    row, code, lettered = ngrams(raw, at)
    for _, _, grams, counts in count_slices(row, code, len(at) - 1, len(row) * len(at) + 1):
        return grams, counts, lettered
    return np.zeros(0, np.int64), np.zeros((0, 0), np.float32), lettered


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    letters = rotated_letters(dimensions)
    out = np.ones((len(grams), dimensions), np.float32)
    for place in range(NGRAM):
        out *= letters[place][grams // CLASSES ** (NGRAM - 1 - place) % CLASSES]
    return out


def bundles(counts: np.ndarray, grams: np.ndarray, dimensions: int) -> np.ndarray:
    """The rows' vectors; many n-grams are taken in parts, so that memory is bounded."""
    out = np.zeros((len(counts), dimensions), np.float32)
    for k in range(0, len(grams), 4096):
        out += counts[:, k : k + 4096] @ gram_vectors(grams[k : k + 4096], dimensions)
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototypes: each language's vector of length one, learned from all rows with a language."""
    spark = task_session(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in passes(batches, "text"):
            names, of = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            row, code, _ = ngrams(*text_bytes(batch.column("text")))
            # A language's texts are one row here.
            order = np.argsort(of[row], kind="stable")
            for first, last, grams, counts in count_slices(of[row][order], code[order], len(names)):
                for name, vector in zip(names[first:last].tolist(), bundles(counts, grams, dimensions), strict=True):
                    total[name] = total.get(name, 0) + vector.astype(np.float64)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "vector": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    own = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull())
    summed = own.mapInArrow(run, "lang string, vector array<double>").select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
    rows = summed.limit(MAX_LANGUAGES * dimensions + 1).toArrow()
    if rows.num_rows > MAX_LANGUAGES * dimensions:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(set(rows.column("lang").to_pylist()))
    vectors = np.zeros((len(names), dimensions))
    vectors[np.searchsorted(names, np.array(rows.column("lang").to_pylist(), str)) if names else [], np.array(rows.column("pos"), np.int64)] = np.array(rows.column("x"))
    return {name: v / max(np.linalg.norm(v), 1e-12) for name, v in zip(names, vectors, strict=True)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (the cosine, 0 at least) to every row."""
    spark = task_session(docs.sparkSession)
    docs = docs.drop(*(c for c in docs.columns if c.lower() in {"lang_pred", "score"}))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = sorted(prototypes)
    sent = spark.sparkContext.broadcast(np.array([prototypes[n] for n in names], np.float32) if names else np.zeros((0, 1), np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in passes(batches, text):
            row, code, lettered = ngrams(*text_bytes(batch.column(text)))
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, last, grams, counts in count_slices(row, code, batch.num_rows) if len(own) else ():
                vectors = bundles(counts, grams, own.shape[1])
                cosine = (vectors @ own.T) / np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
                best[first:last] = cosine.argmax(axis=1)
                score[first:last] = np.clip(cosine.max(axis=1).astype(float), 0, 1)
            known = lettered & (len(own) > 0)
            pred = np.where(known, np.array([*names, UNDETERMINED], object)[best], UNDETERMINED)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(np.where(known, score, 0.0))], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out() -> F.Column:
    """The fold that teaches nothing."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the language of every whole text of ``documents``, learned from four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prototypes = learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    rows = predict(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), prototypes)
    return rows.drop("text")
