"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed once, by blocks of documents: a block holds the postings (word positions) of every word in
it, ordered by word, and is one row of a Parquet table in the shared folder. A search takes the benchmark's windows
of words to every block. There it starts from the rarest word of each window, shifts that word's postings by the
word's offset, and intersects them with the shifted postings of the next rarer word, and so on through all words
(an exact phrase), or asks that all words lie in an interval of a given length (proximity). Words are compared by a
64-bit hash; nothing is sampled or cut. A document's postings lie in one block, so a search shuffles nothing.

The benchmark goes to the tasks in parts of at most ``MAX_TEST_WORDS`` words; a larger one is searched part by part
over the stored index, and each document's hits are united.

Defined cases: null, empty and wordless texts have no words and no hits, such items no window; repeated rows are
documents of their own; an empty benchmark hits nothing; other columns are ignored. Items of a null id are searched for
as others are, and are one item together: a null at the end of a document's items, which counts as one in ``n_items``
and adds nothing to the digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm.arrow_text import lower_words, passes, ranges, span_hashes
from reelspark.llm.store import task_session, new_path

WINDOW = 10
#: Words of the benchmark that go to the tasks at once.
MAX_TEST_WORDS = 400_000
#: Bytes of text in a block of the index.
BLOCK_BYTES = 4 << 20
#: Candidate places that are intersected at once in a block.
_CANDIDATES = 2_000_000
#: Stands for a null id in a block.
_NULL = np.iinfo(np.int64).min
_ABSENT = np.iinfo(np.int32).max

INDEX_SCHEMA = "block long, doc_ids binary, doc_at binary, terms binary, term_at binary, positions binary"


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of whole texts, written to the shared folder.

    ``doc_ids`` and ``doc_at`` have an entry for each document (and one more): its id (long) and its first position.
    Positions of successive documents are one apart, so that no window crosses from one to the next.
    """
    spark = task_session(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in passes(batches, "text", BLOCK_BYTES):
            block = Block.of(batch.column("doc_id"), batch.column("text"))
            parts = [block.doc_ids, block.doc_at, block.terms, block.term_at, block.positions]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["block", "doc_ids", "doc_at", "terms", "term_at", "positions"])
            number += 1

    path = new_path(spark, "postings")
    docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(blocks, INDEX_SCHEMA).write.parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


@dataclass
class Windows:
    """Windows of words: the words' hashes (0 beyond a shorter window's end), lengths, and which item each is of."""

    terms: np.ndarray
    length: np.ndarray
    item: np.ndarray
    items: list[str | None]


def windows_of(items: pa.Table, width: int = WINDOW) -> Windows:
    """All windows of ``width`` consecutive words of each text; a text of fewer words, but not none, is one window."""
    names = items.column("item_id").cast(pa.string()).to_pylist()
    data, starts, ends, before = lower_words(items.column("text").combine_chunks().cast(pa.string()))
    hashes = np.append(span_hashes(data, starts, ends), np.zeros(width, np.uint64))
    words = np.diff(before)
    count = np.where(words > 0, np.maximum(words - width + 1, 1), 0)
    first = ranges(before[:-1], count)
    item = np.repeat(np.arange(len(names)), count)
    length = np.minimum(words, width)[item]
    terms = np.where(np.arange(width) < length[:, None], hashes[first[:, None] + np.arange(width)], np.uint64(0))
    found, pick = np.unique(np.column_stack([terms, item.astype(np.uint64)]), axis=0, return_index=True) if len(item) else (terms, np.zeros(0, np.int64))
    return Windows(terms[pick], length[pick], item[pick], names)


@dataclass
class Block:
    """One block of the index."""

    doc_ids: np.ndarray
    doc_at: np.ndarray
    terms: np.ndarray
    term_at: np.ndarray
    positions: np.ndarray

    @classmethod
    def of(cls, doc_ids: pa.Array, texts: pa.Array) -> Block:
        data, starts, ends, before = lower_words(texts)
        ids = np.array(doc_ids.fill_null(_NULL), np.int64)
        position = np.arange(len(starts)) + np.repeat(np.arange(len(ids)), np.diff(before))
        hashes = span_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        head = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        return cls(ids, (before + np.arange(len(before))).astype(np.int32), hashes[head], np.append(head, len(hashes)).astype(np.int32), position[order].astype(np.int32))

    def ids(self) -> pa.Array:
        return pa.array(self.doc_ids, mask=self.doc_ids == _NULL)

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int) -> Block:
        get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)
        return cls(get("doc_ids", np.int64), get("doc_at", np.int32), get("terms", np.uint64), get("term_at", np.int32), get("positions", np.int32))

    def search(self, windows: Windows, span: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all matches: exact phrases, or all words in ``span`` words from start, in any order."""
        none = np.zeros(0, np.int64)
        if not len(self.terms) or not len(windows.length):
            return none, none
        width = windows.terms.shape[1]
        term = np.minimum(np.searchsorted(self.terms, windows.terms), len(self.terms) - 1)
        inside = np.arange(width) < windows.length[:, None]
        count = np.where(self.terms[term] == windows.terms, np.diff(self.term_at)[term], 0)
        fewest = np.where(inside, count, _ABSENT).min(axis=1)
        alive = np.flatnonzero(fewest > 0)
        order = np.argsort(np.where(inside, count, _ABSENT)[alive], axis=1, kind="stable")
        keys = np.repeat(np.arange(len(self.terms)) << 32, np.diff(self.term_at)) + self.positions if len(alive) else none
        # Windows whose candidates fit in memory go together.
        part = np.cumsum(fewest[alive].astype(np.int64)) // _CANDIDATES
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(alive))
        found = [self._intersect(keys, term[alive[a:b]], windows.length[alive[a:b]], order[a:b], span) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return np.concatenate([none, *(alive[a + p] for a, (p, _) in zip(cuts, found, strict=False))]), np.concatenate([none, *(s for _, s in found)])

    def _intersect(self, keys: np.ndarray, term: np.ndarray, length: np.ndarray, rarest: np.ndarray, span: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The same for windows whose words all occur; ``keys`` are the postings as word << 32 | position, in order."""
        none = np.zeros(0, np.int64)
        place, start = none, none
        for step in range(term.shape[1]):
            if step == 0:  # the rarest word's postings give the places
                row, off = np.arange(len(term)), rarest[:, 0]
                size = np.diff(self.term_at)[term[row, off]]
                place = np.repeat(row, size)
                hit = self.positions[ranges(self.term_at[term[row, off]].astype(np.int64), size)].astype(np.int64)
                if span is None:
                    start = hit - off[place]
                else:
                    place, start = np.repeat(place, span), (hit[:, None] - np.arange(span)).ravel()
                    both = np.unique(np.column_stack([place, start]), axis=0) if len(place) else np.zeros((0, 2), np.int64)
                    place, start = both[:, 0], both[:, 1]
                doc = np.searchsorted(self.doc_at, start, "right") - 1
                ok = start >= 0
                place, start, doc = place[ok], start[ok], doc[ok]
                last = np.minimum(start + (span or 1), self.doc_at[np.minimum(doc + 1, len(self.doc_at) - 1)] - 1) - 1
                if span is None:
                    continue  # its own word is there
            go = length[place] > step
            if not go.any():
                break
            own = np.flatnonzero(go)
            off = rarest[place[own], step]
            wanted = (term[place[own], off].astype(np.int64) << 32) + start[own] + (off if span is None else 0)
            found = keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)]
            keep = np.ones(len(place), bool)
            keep[own] = found == wanted if span is None else (found >= wanted) & (found <= wanted + (last - start)[own])
            place, start, last = place[keep], start[keep], last[keep]
        return place, start


def _part(items: DataFrame, parts: int, part: int, width: int) -> Windows:
    rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
    return windows_of(rows.toArrow(), width)


def _parts(benchmark: DataFrame, item_id: str, text: str, max_test_words: int) -> tuple[DataFrame, int]:
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    # A word has one byte and one byte between words at least.
    words = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    return items, 1 + int(words // max_test_words)


def find(index: DataFrame, benchmark: DataFrame, width: int = WINDOW, span: int | None = None, item_id: str = "item_id", text: str = "text", max_test_words: int = MAX_TEST_WORDS) -> DataFrame:
    """doc_id, item_id (string), start, length: where the benchmark's windows occur.

    Without ``span`` exact phrases, ``start`` counting words from 0. With it, each start of an interval of ``span``
    words, within one document, that holds every word of the window in any order (a word twice in a window counts
    once); ``length`` is then ``span``.
    """
    spark = task_session(index.sparkSession)
    items, parts = _parts(benchmark, item_id, text, max_test_words)
    out = None
    for part in range(parts):
        sent = spark.sparkContext.broadcast(_part(items, parts, part, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows = sent.value
            for batch in batches:
                for row in range(batch.num_rows):
                    block = Block.read(batch, row)
                    window, start = block.search(windows, span)
                    doc = np.searchsorted(block.doc_at, start, "right") - 1
                    item = pa.array([windows.items[i] for i in windows.item[window]], pa.string())
                    length = windows.length[window] if span is None else np.full(len(window), span)
                    yield pa.RecordBatch.from_arrays([block.ids().take(pa.array(doc)), item, pa.array((start - block.doc_at[doc]).astype(np.int64)), pa.array(length.astype(np.int64))], names=["doc_id", "item_id", "start", "length"])

        one = index.mapInArrow(run, "doc_id long, item_id string, start long, length long")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


_HITS = "block long, row long, doc_id long, n_words long, spans array<long>, items array<string>"


def _hits(block: Block, windows: Windows, number: int) -> pa.RecordBatch:
    """For each document: the united intervals of hit words (start, end, start, end, ...) and the items that occur."""
    window, start = block.search(windows)
    n = len(block.doc_ids)
    order = np.lexsort((start,))
    window, start = window[order], start[order]
    end = start + windows.length[window]
    doc = np.searchsorted(block.doc_at, start, "right") - 1
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.zeros(0, bool)  # documents are one apart
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    base = block.doc_at[doc[first]] if len(first) else first
    edges = np.column_stack([start[first] - base, reach[last] - base]).ravel().astype(np.int64)
    pairs = np.unique(np.column_stack([doc, windows.item[window]]), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    spans_at = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=n) * 2)])
    items_at = np.concatenate([[0], np.cumsum(np.bincount(pairs[:, 0], minlength=n))])
    names = pa.array([windows.items[i] for i in pairs[:, 1]], pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number)), pa.array(np.arange(n)), block.ids(), pa.array((np.diff(block.doc_at) - 1).astype(np.int64)), pa.ListArray.from_arrays(spans_at.astype(np.int32), pa.array(edges)), pa.ListArray.from_arrays(items_at.astype(np.int32), names)],
        names=["block", "row", "doc_id", "n_words", "spans", "items"],
    )


def contamination(index: DataFrame, benchmark: DataFrame, width: int = WINDOW, item_id: str = "item_id", text: str = "text", max_test_words: int = MAX_TEST_WORDS) -> DataFrame:
    """For each document: doc_id, n_words, n_hit (words inside an occurrence of a window), items (those that occur,
    sorted as strings), spans (the hit intervals in words: start, end, start, end, ...), contaminated."""
    spark = task_session(index.sparkSession)
    items, parts = _parts(benchmark, item_id, text, max_test_words)
    each = []
    for part in range(parts):
        sent = spark.sparkContext.broadcast(_part(items, parts, part, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    yield _hits(Block.read(batch, row), sent.value, batch.column("block")[row].as_py())

        each.append(index.mapInArrow(run, _HITS))
    hits = each[0]
    if parts > 1:
        for one in each[1:]:
            hits = hits.unionByName(one)
        # A document has one row for each part of the benchmark at most.
        hits = hits.groupBy("block", "row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("spans").alias("each"), F.flatten(F.collect_list("items")).alias("items"))
        pairs = F.array_sort(F.flatten(F.transform("each", _as_pairs)))
        hits = hits.withColumn("spans", _union(pairs))
    spans = F.col("spans")
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size(spans)), F.lit(0).cast("long"), lambda t, k: t + F.when(k < F.size(spans), F.when(k % 2 == 1, F.get(spans, k)).otherwise(-F.get(spans, k))).otherwise(0))
    hits = hits.withColumn("items", F.array_sort(F.array_distinct("items"))).withColumn("n_hit", n_hit)
    return hits.select("doc_id", "n_words", "n_hit", "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text", max_test_words: int = MAX_TEST_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with ``contaminated``: for a corpus that is searched once, its blocks of
    postings are built, searched and dropped in the same task. A benchmark of several parts takes a step for each."""
    spark = task_session(docs.sparkSession)
    items, parts = _parts(benchmark, item_id, item_text, max_test_words)
    out = docs.drop(*(c for c in docs.columns if c.lower() == "contaminated")).withColumn("contaminated", F.lit(False))
    schema = out.schema
    for part in range(parts):
        sent = spark.sparkContext.broadcast(_part(items, parts, part, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in passes(batches, text):
                block = Block.of(pa.nulls(batch.num_rows, pa.int64()), batch.column(text))
                _, start = block.search(sent.value)
                hit = np.array(batch.column("contaminated"))
                hit[np.searchsorted(block.doc_at, start, "right") - 1] = True
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hit)], names=schema.names)

        out = out.mapInArrow(run, schema)
    return out


def _as_pairs(flat: F.Column) -> F.Column:
    """[a, b, c, d] as [(a, b), (c, d)]."""
    return F.filter(F.transform(flat, lambda x, k: F.struct(x.alias("a"), F.get(flat, k + 1).alias("b"), (k % 2 == 0).alias("first"))), lambda p: p["first"])


def _union(pairs: F.Column) -> F.Column:
    """Sorted intervals as the flat list of their union."""
    empty = F.array().cast("array<bigint>")
    grow = lambda out, p: F.when(
        (F.size(out) > 0) & (p["a"] <= F.element_at(out, -1)), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(F.element_at(out, -1), p["b"])))
    ).otherwise(F.concat(out, F.array(p["a"], p["b"])))
    return F.when(F.size(pairs) == 0, empty).otherwise(F.aggregate(pairs, empty, grow))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: how much of each whole text of ``documents`` lies in windows of ``benchmark`` texts."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = contamination(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_WORD}') w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(coalesce({_LOWER}, ''), '{_WORD}') w FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_slice(w, k, k + {WINDOW} - 1) win
  FROM b, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS u(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(win) n FROM windows),
grams AS (
  SELECT doc_id, k, n, list_slice(w, k, k + n - 1) win
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(k) WHERE len(w) >= n),
hits AS (SELECT doc_id, k, n, item FROM grams JOIN windows USING (win)),
words AS (SELECT doc_id, count(DISTINCT p) n_hit FROM hits, unnest(range(k, k + n)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items,
  sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
