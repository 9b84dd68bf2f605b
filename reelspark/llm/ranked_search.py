"""Ranked lexical search over document FP-trees.

Only the terms of the items matter, so each document is first restricted to them: its vector holds (term, tf) for
the items' terms alone. The vectors are written once, in blocks of documents, with the document lengths and each
block's document frequencies, which sum to the statistics of the whole table. Then each task reads blocks and makes a
tree of each: terms are ordered by falling document frequency, so vectors that begin with the same frequent terms share
a path, and a node stands for the documents below its path. A node keeps, for the terms that occur below it, the largest
tf, and the least m (the length part of the score). A term's part of a score rises with tf and falls with m, so the sum
over an item's terms at these extremes bounds the score of every document below. For each item the tree is searched depth
first, children of the highest bound first, and a subtree is left out when its bound can't reach the tenth best score
found so far in the task. What is left of each task, ten documents an item at most, is ranked by Spark.

Scores follow the weights of the contract: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), a part is
weight * ((10^9 tf) div (1000 tf + 8 m)), m is 25 + (75 n N) div L; all but the weight in 64-bit integers.

The items go to the tasks in parts of at most ``MAX_ITEM_WORDS`` words; more of them are searched part by part.

Defined cases: null, empty and termless texts are in no result and do not count in N; an item without a term finds
nothing; repeated rows are documents, and repeated item rows are items, of their own; among equal scores a null doc_id
comes last; an empty table finds nothing; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.llm.arrow_text import lower_words, passes, ranges, span_hashes
from reelspark.llm.store import new_path, task_session

K = 10
#: Words of the items that go to the tasks at once; statistics and broadcasts have so many entries at most.
MAX_ITEM_WORDS = 1_000_000
#: Documents below a node that are scored at once instead of being divided further.
LEAF = 32
#: Entries of restricted vectors in a block, one document at least.
BLOCK_ENTRIES = 1 << 19

_NULL = np.iinfo(np.int64).max
_VECTORS = "documents long, terms long, doc_ids binary, lengths binary, at binary, term binary, tf binary"


@dataclass
class Items:
    """The terms of all items by hash, and each item's terms (numbers in ``hashes``) with how often it repeats them."""

    hashes: np.ndarray
    at: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Items:
        data, starts, ends, before = lower_words(texts)
        hashes, term = np.unique(span_hashes(data, starts, ends), return_inverse=True)
        item = np.repeat(np.arange(len(texts)), np.diff(before))
        pair, times = np.unique(item * max(len(hashes), 1) + term, return_counts=True)
        at = np.searchsorted(pair, np.arange(len(texts) + 1) * max(len(hashes), 1))
        return cls(hashes, at, pair % max(len(hashes), 1), times)


@dataclass
class Vectors:
    """A block of restricted vectors; rows of ``term`` and ``tf`` between entries of ``at`` belong to one document."""

    doc_ids: np.ndarray
    lengths: np.ndarray
    at: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int) -> Vectors:
        get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)
        return cls(get("doc_ids", np.int64), get("lengths", np.int64), get("at", np.int64), get("term", np.int32).astype(np.int64), get("tf", np.int32).astype(np.int64))


def restrict(docs: DataFrame, hashes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of the documents' vectors over the terms in ``hashes`` (sorted), written to the shared folder.

    Documents without any of the terms count in ``documents`` and ``terms`` and are in no vector.
    """
    spark = task_session(docs.sparkSession)
    sent = spark.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries, documents, terms = [], 0, 0, 0

        def block() -> pa.RecordBatch:
            ids, lengths, sizes, term, tf = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 5
            parts = [ids.astype(np.int64), lengths.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), term.astype(np.int32), tf.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["documents", "terms", "doc_ids", "lengths", "at", "term", "tf"])

        for batch in passes(batches, "text"):
            one, count = _vectors(batch, sent.value)
            documents, terms = documents + int((count > 0).sum()), terms + int(count.sum())
            held.append(one)
            entries += len(one[3])
            if entries >= BLOCK_ENTRIES:
                yield block()
                held, entries, documents, terms = [], 0, 0, 0
        if documents:
            yield block()

    path = new_path(spark, "vectors")
    docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _VECTORS).write.parquet(path)
    return spark.read.schema(_VECTORS).parquet(path)


def _vectors(batch: pa.RecordBatch, hashes: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Ids, lengths, sizes, terms and tf of the documents that hold a term of the items; the number of terms of every row."""
    data, starts, ends, before = lower_words(batch.column("text"))
    count = np.diff(before)
    own = span_hashes(data, starts, ends)
    place = np.minimum(np.searchsorted(hashes, own), max(len(hashes) - 1, 0))
    wanted = np.flatnonzero(hashes[place] == own) if len(hashes) else np.zeros(0, np.int64)
    row = np.searchsorted(before, wanted, "right") - 1
    pair, tf = np.unique(row * max(len(hashes), 1) + place[wanted], return_counts=True)
    row, term = np.divmod(pair, max(len(hashes), 1))
    sizes = np.bincount(row, minlength=batch.num_rows)
    some = np.flatnonzero(sizes)
    ids = np.array(batch.column("doc_id").fill_null(_NULL), np.int64)
    return (ids[some], count[some], sizes[some], term, tf), count


@dataclass
class Statistics:
    documents: int
    terms: int
    df: np.ndarray


def statistics(vectors: DataFrame, size: int) -> Statistics:
    """Documents and terms of the whole table, and in how many documents each of the ``size`` terms occurs."""
    totals = vectors.agg(F.sum("documents"), F.sum("terms")).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                df += np.bincount(Vectors.read(batch, row).term, minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(df[some])], names=["term", "df"])

    found = vectors.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[np.array(found.column("term"))] = np.array(found.column("df"))
    return Statistics(totals[0] or 0, totals[1] or 0, df)


def weights(found: Statistics) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term; never below 0, as no term is in more than N documents."""
    return np.array([math.floor(1000 * math.log((2 * found.documents + 2) / (2 * int(df) + 1))) for df in found.df], np.int64)


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight; rises with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """The FP-tree of one block: nodes in the order of their depth, each with the children and the documents below it.

    ``below_*`` has a run of entries for each node: the terms that occur below it and the most each can add.
    """

    def __init__(self, block: Vectors, rank: np.ndarray, found: Statistics):
        order = np.lexsort((rank[block.term], np.repeat(np.arange(len(block.doc_ids)), np.diff(block.at))))
        self.doc_ids = block.doc_ids
        self.m = 25 + (75 * block.lengths * found.documents) // max(found.terms, 1)
        self.at, self.term, self.tf = block.at, block.term[order], block.tf[order]
        self._divide(rank)
        self._gather()

    def _divide(self, rank: np.ndarray) -> None:
        """Documents in the order of their paths; a node is divided by the next term of its documents' paths."""
        size = np.diff(self.at)
        docs = np.arange(len(size))  # in path order, improved level by level
        low, high, depth = [0], [len(size)], 0
        first_child, children = [0], [0]
        open_nodes = np.array([0]) if len(size) > LEAF else np.zeros(0, np.int64)
        while len(open_nodes):
            lows, highs = np.array(low)[open_nodes], np.array(high)[open_nodes]
            place = ranges(lows, highs - lows)
            node = np.repeat(np.arange(len(open_nodes)), highs - lows)
            own = docs[place]
            has = size[own] > depth
            step = np.full(len(own), -1)
            step[has] = rank[self.term[self.at[own[has]] + depth]]
            order = np.lexsort((step, node))
            docs[place] = own[order]
            node, step = node[order], step[order]
            cut = np.flatnonzero(np.diff(node, prepend=-1) | np.diff(step, prepend=-2))
            ends = np.append(cut[1:], len(node))
            pieces = np.bincount(node[cut], minlength=len(open_nodes))
            still = []
            for k, parent in enumerate(open_nodes):
                begin = int(np.searchsorted(node[cut], k))
                if pieces[k] == 1:  # all go on along one path, which needs no node of its own
                    if step[cut[begin]] >= 0:
                        still.append(parent)
                    continue
                first_child[parent], children[parent] = len(low), int(pieces[k])
                for piece in range(begin, begin + int(pieces[k])):
                    at, end = int(place[cut[piece]]), int(place[ends[piece] - 1]) + 1
                    if end - at > LEAF and step[cut[piece]] >= 0:
                        still.append(len(low))
                    low.append(at)
                    high.append(end)
                    first_child.append(0)
                    children.append(0)
            open_nodes, depth = np.array(still, np.int64), depth + 1
        self.docs, self.low, self.high = docs, np.array(low), np.array(high)
        self.first_child, self.children = np.array(first_child), np.array(children)

    def _gather(self) -> None:
        """Vectors in path order, each entry's part of a score, and the extremes below each node."""
        size = np.diff(self.at)[self.docs]
        entry = ranges(self.at[self.docs], size)
        self.doc_ids, self.m = self.doc_ids[self.docs], self.m[self.docs]
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.term, self.tf = self.term[entry], self.tf[entry]
        self.part = part(self.tf, np.repeat(self.m, size))
        terms, parts, counts = [], [], []
        for low, high in zip(self.low, self.high, strict=True):
            own, tf = self.term[self.at[low] : self.at[high]], self.tf[self.at[low] : self.at[high]]
            order = np.argsort(own, kind="stable")
            heads = np.flatnonzero(np.diff(own[order], prepend=-1))
            terms.append(own[order][heads])
            parts.append(part(np.maximum.reduceat(tf[order], heads), self.m[low:high].min()) if len(heads) else heads)
            counts.append(len(heads))
        self.below_at = np.concatenate([[0], np.cumsum(counts)])
        self.below_term, self.below_part = np.concatenate(terms), np.concatenate(parts)
        self.least_id = np.array([self.doc_ids[low:high].min() for low, high in zip(self.low, self.high, strict=True)]) if len(self.doc_ids) else np.zeros(1, np.int64)

    def bounds(self, first: int, last: int, weight: np.ndarray) -> np.ndarray:
        """The most a document below each of these nodes can score; ``weight`` is the item's for each term."""
        at = self.below_at[first : last + 1]
        return np.add.reduceat(weight[self.below_term[at[0] : at[-1]]] * self.below_part[at[0] : at[-1]], at[:-1] - at[0])

    def search(self, weight: np.ndarray, best: Best) -> int:
        """Takes the documents of the highest scores into ``best``; how many were scored."""
        scored = 0
        if not len(self.doc_ids):
            return scored
        stack = [(int(self.bounds(0, 1, weight)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound == 0 or not best.open_to(bound, self.least_id[node]):
                continue
            if self.children[node]:
                first, last = self.first_child[node], self.first_child[node] + self.children[node]
                bounds = self.bounds(first, last, weight)
                order = np.argsort(bounds, kind="stable")  # the highest bound is popped first
                stack += [(int(bounds[k]), int(first + k)) for k in order if bounds[k] > 0]
                continue
            low, high = self.low[node], self.high[node]
            at = self.at[low : high + 1]
            scores = np.add.reduceat(weight[self.term[at[0] : at[-1]]] * self.part[at[0] : at[-1]], at[:-1] - at[0])
            best.take(scores, self.doc_ids[low:high])
            scored += high - low
        return scored


class Best:
    """The k best documents of an item so far: highest scores first, equal ones by ascending id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def open_to(self, score: int, doc_id: int) -> bool:
        """Whether a document of this score (at most) and id (at least) can still enter."""
        return len(self.ids) < self.k or score > self.scores[-1] or (score == self.scores[-1] and doc_id < self.ids[-1])

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores > 0
        if len(self.ids) == self.k:
            some &= scores >= self.scores[-1]
        if some.any():
            scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


def _best(vectors: DataFrame, items: Items, found: Statistics, k: int, number: np.ndarray) -> DataFrame:
    """item (its number), doc_id, score: the k best of every task for each item."""
    rank = np.empty(len(items.hashes), np.int64)
    rank[np.lexsort((items.hashes, -found.df))] = np.arange(len(items.hashes))
    sent = vectors.sparkSession.sparkContext.broadcast((items, rank, weights(found), found, number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rank, weight, found, number = sent.value
        best = [Best(k) for _ in number]
        own = np.zeros(len(items.hashes), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                tree = Tree(Vectors.read(batch, row), rank, found)
                for n in range(len(number)):
                    term = items.term[items.at[n] : items.at[n + 1]]
                    own[term] = weight[term] * items.times[items.at[n] : items.at[n + 1]]
                    tree.search(own, best[n])
                    own[term] = 0
        ids = np.concatenate([np.zeros(0, np.int64), *(b.ids for b in best)])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(number, [len(b.ids) for b in best])), pa.array(ids, mask=ids == _NULL), pa.array(np.concatenate([np.zeros(0, np.int64), *(b.scores for b in best)]))], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", max_item_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    # A word has one byte and one byte between words at least.
    words = named.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    parts = 1 + int(words // max_item_words)
    ids, out = [], None
    for p in range(parts):
        rows = (named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) if parts > 1 else named).toArrow()
        some = Items.of(rows.column("text").combine_chunks().cast(pa.string()))
        number = np.arange(len(ids), len(ids) + rows.num_rows)
        ids += rows.column("item_id").to_pylist()
        vectors = restrict(docs, some.hashes, doc_id, text)
        one = _best(vectors, some, statistics(vectors, len(some.hashes)), k, number)
        out = one if out is None else out.unionByName(one)
    kind = named.schema["item_id"].dataType
    names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind.simpleString()}")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the ten best of all ``documents`` for each ``benchmark`` item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_TERM}') t FROM documents),
i AS (SELECT row_number() OVER () q, item_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_TERM}') t FROM benchmark),
s AS (SELECT count(*) FILTER (WHERE len(t) > 0) n, coalesce(sum(len(t)), 0)::BIGINT l FROM d),
tf AS (SELECT r, w, count(*) tf FROM (SELECT r, unnest(t) w FROM d) GROUP BY r, w),
df AS (SELECT w, count(*) df FROM tf GROUP BY w),
x AS (SELECT q, w, count(*) times FROM (SELECT q, unnest(t) w FROM i) GROUP BY q, w),
scored AS (
  SELECT q, r, sum(times * CAST(floor(1000 * ln((2 * s.n + 2) / (2 * df.df + 1))) AS BIGINT)
    * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 75 + (75 * len(d.t) * s.n) // s.l))))::BIGINT score
  FROM x JOIN df USING (w) JOIN tf USING (w) JOIN d USING (r), s GROUP BY q, r),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) k
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE k <= {K}
"""
