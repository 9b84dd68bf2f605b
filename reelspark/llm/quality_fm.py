"""Quality classification with a factorisation machine.

Features of a text are its hashed words and statistics of its structure and size (shares of capitals, digits, marks,
distinct words, repetitions), each cut into intervals. Every feature has a weight and a short vector, and a pair of
features counts by the product of their vectors. All pairs are summed in linear time: half of the square of the sum
less the sum of the squares, for each place of the vectors.

The machine is fitted on the driver on at most ``MAX_TRAINING`` labelled rows, of which only features arrive there;
scoring goes over all whole texts in Arrow tasks.

Defined cases: null and empty texts have the statistics of an empty text and are scored; without labelled rows of
both kinds every score is the share of good ones (0.5 without any); repeated rows get equal scores; other columns
are carried along, and ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.arrow_text import LOWER, WORD, SpanHasher, mix, passes, text_bytes, word_spans
from reelspark.llm.labelled import fold, sample
from reelspark.llm.store import task_session

#: Labelled rows that the machine is fitted on.
MAX_TRAINING = 8000
WORD_BUCKETS = 1 << 14
FACTORS = 8
#: Bounds of the intervals as quantiles of the labelled rows; close at the ends, as what is odd is rare.
QUANTILES = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99)
INTERVALS = len(QUANTILES) + 1

_KINDS = np.zeros(256, np.int64)  # of bytes: 0 other marks, then these
for _kind, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b"!", b"|", b".,;:?'\"-()", bytes(range(128, 256))), 1):
    _KINDS[list(_bytes)] = _kind
STATISTICS = 18


@dataclass
class Rows:
    """Word features (row, bucket, value) and statistics of a slice of texts."""

    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def _distinct(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, hash and count of the distinct pairs."""
    if not len(row):
        return row, hashes, np.zeros(0, np.int64)
    # A row's hashes are told apart from another row's by mixing its number in.
    keyed = mix(hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), 21)
    order = np.argsort(keyed)
    head = np.flatnonzero(np.concatenate([[True], keyed[order][1:] != keyed[order][:-1]]))
    return row[order][head], hashes[order][head], np.diff(np.append(head, len(order)))


def read_rows(column: pa.Array) -> Rows:
    raw, at = text_bytes(column)
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1)
    of = np.repeat(np.arange(n), np.diff(at))
    kinds = np.bincount(of * 10 + _KINDS[raw], minlength=n * 10).reshape(n, 10)
    data = LOWER[raw]
    starts, ends = word_spans(WORD[data], at)
    before = np.searchsorted(starts, at)
    words = np.diff(before)
    count = np.maximum(words, 1)
    row = np.repeat(np.arange(n), words)
    hashes = SpanHasher(data).of(starts, ends)
    d_row, d_hash, d_count = _distinct(row, hashes)
    distinct = np.bincount(d_row, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, d_row, d_count)
    same = np.zeros(n)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    same = np.bincount(row[pairs], hashes[pairs] == hashes[pairs + 1], minlength=n)
    triple = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    t_row, _, _ = _distinct(row[triple], mix(hashes[triple] * np.uint64(3) + hashes[triple + 1] * np.uint64(5) + hashes[triple + 2] * np.uint64(7), 22))
    triples = np.bincount(t_row, minlength=n) / np.maximum(np.bincount(row[triple], minlength=n), 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 9], 1)
    length = np.bincount(row, ends - starts, minlength=n) / count
    one_letter = np.bincount(row, (ends - starts) == 1, minlength=n) / count
    statistics = np.column_stack([
        np.log1p(np.diff(at)), np.log1p(words), kinds[:, 1] / letters, kinds[:, 3] / size, kinds[:, 4] / size, kinds[:, 5] / count, kinds[:, 6] / count, kinds[:, 7] / count, kinds[:, 8] / count,
        kinds[:, 0] / count, kinds[:, 9] / letters, length, distinct / count, top / count, same / count, triples, one_letter, distinct / np.sqrt(count),
    ])
    value = np.log1p(d_count)
    value /= np.sqrt(np.maximum(np.bincount(d_row, value**2, minlength=n), 1e-12))[d_row]
    return Rows(d_row, (d_hash & np.uint64(WORD_BUCKETS - 1)).astype(np.int64), value, statistics)


@dataclass
class Machine:
    """A fitted factorisation machine; ``cuts`` are the intervals' bounds of each statistic."""

    cuts: np.ndarray
    bias: float
    weight: np.ndarray
    vector: np.ndarray

    def features(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(rows.statistics)
        held = np.column_stack([np.searchsorted(self.cuts[s], rows.statistics[:, s], "right") + s * INTERVALS + WORD_BUCKETS for s in range(STATISTICS)])
        row = np.concatenate([rows.row, np.repeat(np.arange(n), STATISTICS)])
        return row, np.concatenate([rows.bucket, held.ravel()]), np.concatenate([rows.value, np.full(n * STATISTICS, 1.0)])

    def odds(self, n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log-odds of n rows and, for the gradient, the sums of their vectors."""
        linear = np.bincount(row, self.weight[feature] * value, minlength=n)
        sums, squares = np.zeros((n, FACTORS)), np.zeros(n)
        for f in range(FACTORS):
            part = self.vector[feature, f] * value
            sums[:, f] = np.bincount(row, part, minlength=n)
            squares += np.bincount(row, part * part, minlength=n)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def score(self, rows: Rows) -> np.ndarray:
        odds, _ = self.odds(len(rows.statistics), *self.features(rows))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(rows: list[tuple[Rows, np.ndarray]], epochs: int = 20, batch: int = 64, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """Fits by stochastic gradient steps scaled by each parameter's past; deterministic."""
    label = np.concatenate([y for _, y in rows]) if rows else np.zeros(0)
    statistics = np.concatenate([r.statistics for r, _ in rows]) if rows else np.zeros((1, STATISTICS))
    cuts = np.quantile(statistics, QUANTILES, axis=0).T
    size = WORD_BUCKETS + STATISTICS * INTERVALS
    random = np.random.default_rng(4)
    share = np.clip(label.mean(), 0.01, 0.99) if len(label) else 0.5
    machine = Machine(cuts, float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, FACTORS)))
    if not 0 < label.sum() < len(label):
        machine.vector[:] = 0
        return machine
    each = []
    for r, _ in rows:
        row, feature, value = machine.features(r)
        order = np.argsort(row, kind="stable")
        cut = np.searchsorted(row[order], np.arange(1, len(r.statistics)))
        each += zip(np.split(feature[order], cut), np.split(value[order], cut), strict=True)
    past_w, past_v, past_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = random.permutation(len(each))
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            feature = np.concatenate([each[i][0] for i in own])
            value = np.concatenate([each[i][1] for i in own])
            row = np.repeat(np.arange(len(own)), [len(each[i][0]) for i in own])
            odds, sums = machine.odds(len(own), row, feature, value)
            error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - label[own]) / len(own)
            pull = error[row] * value
            used, place = np.unique(feature, return_inverse=True)
            g_w = np.bincount(place, pull, minlength=len(used)) + decay * machine.weight[used]
            past_w[used] += g_w**2
            machine.weight[used] -= rate * g_w / np.sqrt(past_w[used])
            for f in range(FACTORS):
                g_v = np.bincount(place, pull * (sums[row, f] - machine.vector[feature, f] * value), minlength=len(used)) + decay * machine.vector[used, f]
                past_v[used, f] += g_v**2
                machine.vector[used, f] -= 0.3 * rate * g_v / np.sqrt(past_v[used, f])
            past_b += error.sum() ** 2
            machine.bias -= rate * error.sum() / np.sqrt(past_b)
    return machine


def train(labelled: DataFrame) -> Machine:
    """Fits on the rows (text, label) of a bounded frame; only their features come to the driver."""
    task_session(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            rows = read_rows(batch.column("text"))
            n = batch.num_rows
            order = np.argsort(rows.row, kind="stable")
            at = np.searchsorted(rows.row[order], np.arange(n + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(at, pa.array(v[order])) for v in (rows.bucket.astype(np.int32), rows.value.astype(np.float32))]
            flat = pa.ListArray.from_arrays(np.arange(0, n * STATISTICS + 1, STATISTICS, dtype=np.int32), pa.array(rows.statistics.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists, flat], names=["label", "bucket", "value", "statistics"])

    found = labelled.mapInArrow(run, "label int, bucket array<int>, value array<float>, statistics array<double>").toArrow()
    parts = []
    for batch in found.to_batches():
        count = np.diff(np.array(batch.column("bucket").offsets))
        flat = lambda name, kind: np.array(batch.column(name).flatten(), kind)  # noqa: B023, E731
        parts.append((Rows(np.repeat(np.arange(batch.num_rows), count), flat("bucket", np.int64), flat("value", float), flat("statistics", float).reshape(-1, STATISTICS)), np.array(batch.column("label"), float)))
    return fit(parts)


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, higher: better) to every row."""
    spark = task_session(docs.sparkSession)
    docs = docs.drop(*(c for c in docs.columns if c.lower() == "score"))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    sent = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.score(read_rows(batch.column(text))))], names=schema.names)

    return docs.mapInArrow(run, schema)


def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the quality of every whole text of ``documents``, learned from labels outside fold 0 of 5."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    machine = train(sample(docs, labels, "quality", fold(5) != 0, MAX_TRAINING))
    rows = score(docs.select("doc_id", (fold(5) == 0).alias("held_out"), "text"), machine).drop("text")
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
