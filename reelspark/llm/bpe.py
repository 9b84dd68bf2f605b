"""Byte-level BPE encoding and decoding with numpy inside Arrow tasks.

Pre-tokenising uses no regular expression. Each code point gets a class (letter, number, white space, other). Read
as a machine that says whether a piece starts here, each code point is a transition function, and the composition
of three successive ones no longer depends on the state before them. An associative prefix scan over such functions
therefore reduces to comparing each class array with itself shifted by one and two places, which also never looks
across the end of a text. The slices between starts are looked up in a cache; only slices not seen before are
merged, all of them together, one merge for each slice and round.

Defined cases: a null or empty text has no ids; text that looks like a special token is ordinary text; repeated
rows give repeated results; other columns of the input are carried along untouched.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.arrow_text import HashIndex, binary_array, code_points, passes, ranges, span_hashes, text_bytes
from reelspark.llm.store import task_session

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Slices in a worker's cache beyond which it keeps only those that it met again.
CACHE_PIECES = 400_000
#: Longer slices are merged one by one with a heap.
LONG_PIECE = 128
_NONE = np.iinfo(np.int64).max


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    return table


def piece_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions at which the pieces of all texts start; ``at`` has the texts' own starts and the end."""
    points, where = code_points(raw)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = class_table()[points]
    first = np.zeros(n + 1, bool)  # starts of texts, and one beyond the end
    first[np.searchsorted(where, at)] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run[:n].copy()
    # The last white space before something else stands alone, or is a blank that joins what follows.
    after = np.flatnonzero(run[1:n] & ~first[1:n] & (kind[:-1] == SPACE)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    # A lone apostrophe that starts a piece takes one or two letters with it.
    mark = np.flatnonzero((points == 39) & start & run[1:])
    mark = mark[(mark + 1 < n)]
    mark = mark[~first[mark + 1]]
    one = points[mark + 1]
    two = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n)], points[np.minimum(mark + 2, n - 1)], 0)
    taken = np.where(np.isin(one, [115, 116, 109, 100]), 2, 0)  # 's 't 'm 'd
    pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # 're 've 'll
    taken = np.where(pair, 3, taken)
    mark, taken = mark[taken > 0], taken[taken > 0]
    start[mark + 1] = False
    beyond = mark + taken
    beyond = beyond[beyond < n]
    beyond = beyond[(kind[beyond] == LETTER) & ~first[beyond]]
    start[beyond] = True
    return where[start]


def _after(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """A buffer whose first ``n`` entries are followed by ``more``, of twice the room if they don't fit."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.zeros(n + 2 * len(more), held.dtype)])
    held[n : n + len(more)] = more
    return held


class PieceCache:
    """Ids of texts, piece by piece: pieces met before are looked up, others go to ``merge`` together."""

    room = CACHE_PIECES

    def __init__(self) -> None:
        self._clear()

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and how many each has."""
        raise NotImplementedError

    def _clear(self) -> None:
        self.pieces, self.held = HashIndex(), 0
        # Buffers that are doubled when full: the pieces' bytes and ids, and where each piece's start and end in them.
        self.store, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.int32)
        self.store_at, self.first = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # met in a later pass than their first, or than the last one of _forget

    def _put(self, hashes: np.ndarray, store: np.ndarray, size: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        n = self.held
        self.pieces.add(hashes, np.arange(len(hashes)) + n)
        self.store, self.ids = _after(self.store, self.store_at[n], store), _after(self.ids, self.first[n], ids)
        self.store_at, self.first = (_after(x, n + 1, x[n] + np.cumsum(y)) for x, y in ((self.store_at, size), (self.first, count)))
        self.again = _after(self.again, n, np.zeros(len(hashes), bool))
        self.held += len(hashes)

    def _forget(self) -> None:
        """Keeps the pieces met again; none if these alone are more than three quarters of the room."""
        again = self.again[self.pieces.value] & (self.pieces.key != -1)
        if (number := int(again.sum())) * 4 > self.room * 3:
            return self._clear()
        hashes, keep = self.pieces.key[again], self.pieces.value[again]
        store, store_at, ids, first = self.store, self.store_at, self.ids, self.first
        size, count = store_at[keep + 1] - store_at[keep], first[keep + 1] - first[keep]
        self._clear()
        if number:
            self._put(hashes, store[ranges(store_at[keep], size)], size, ids[ranges(first[keep], count)], count)

    def _learn(self, hashes: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Merges slices that are not in the cache, one for each hash, and adds them."""
        hashes, pick = np.unique(hashes, return_index=True)
        starts, ends = starts[pick], ends[pick]
        whole = raw.tobytes()
        ids, count = self.merge([whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        self._put(hashes, raw[ranges(starts, ends - starts)], ends - starts, ids, count)

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many come before each text."""
        if self.held > self.room:
            self._forget()
        starts = piece_starts(raw, at)
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        hashes = span_hashes(raw, starts, ends).view(np.int64) >> 1  # no negative keys
        known = self.pieces.find(hashes)
        self.again[known[known >= 0]] = True
        if (new := np.flatnonzero(known < 0)).size:
            self._learn(hashes[new], raw, starts[new], ends[new])
            known[new] = self.pieces.find(hashes[new])
        ids, first = self.ids, self.first[known]
        count = self.first[known + 1] - first
        wrong = self._differ(known, raw, starts, ends - starts)
        if wrong.size:  # two slices of one hash
            whole = raw.tobytes()
            more, count[wrong] = self.merge([whole[a:b] for a, b in zip(starts[wrong].tolist(), ends[wrong].tolist(), strict=True)])
            first[wrong] = len(ids) + np.cumsum(count[wrong]) - count[wrong]
            ids = np.concatenate([ids, more.astype(np.int32)])
        before = np.concatenate([[0], np.cumsum(count)])
        return ids[ranges(first, count)], before[np.searchsorted(starts, at)]

    def _differ(self, known: np.ndarray, raw: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slices whose bytes are not those of the cached piece of the same hash."""
        begin = self.store_at[known]
        wrong = self.store_at[known + 1] - begin != size
        same = np.flatnonzero(~wrong)
        length = size[same]
        unequal = self.store[ranges(begin[same], length)] != (raw if len(same) == len(size) else raw[ranges(starts[same], length)])
        if unequal.any():
            wrong[same[np.unique(np.searchsorted(np.cumsum(length), np.flatnonzero(unequal), "right"))]] = True
        return np.flatnonzero(wrong)


class Encoder(PieceCache):
    """The ranks of a byte-level BPE vocabulary."""

    def __init__(self, rank_file: bytes):
        super().__init__()
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        top = max(self.ranks.values()) + 1
        words = [b""] * top
        for word, rank in self.ranks.items():
            words[rank] = word
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.word_len = np.array([len(w) for w in words], np.int64)
        self.word_at = np.cumsum(self.word_len) - self.word_len
        pairs = {}
        for word, rank in self.ranks.items():
            for cut in range(1, len(word)):
                left, right = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.pairs = HashIndex()
        self.pairs.add(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs)))

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what each pair merges to, or the largest integer."""
        rank = self.pairs.find(left << 20 | right)
        return np.where(rank < 0, _NONE, rank)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and how many each has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        long = np.flatnonzero(size > LONG_PIECE)
        done_ids, done_of = [], []
        for k in long.tolist():
            done_ids.append(np.array(self._merge_long(pieces[k]), np.int64))
            done_of.append(np.full(len(done_ids[-1]), k))
        short = np.flatnonzero(size <= LONG_PIECE)
        ids = self.byte_rank[np.frombuffer(b"".join([pieces[k] for k in short.tolist()]), np.uint8)]
        of = np.repeat(short, size[short])
        while len(ids):
            rank = np.full(len(ids), _NONE, np.int64)
            inside = np.flatnonzero(of[1:] == of[:-1])
            rank[inside] = self.pair_rank(ids[inside], ids[inside + 1])
            head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.minimum.reduceat(rank, head)
            length = np.diff(np.append(head, len(ids)))
            over = np.repeat(best == _NONE, length)
            done_ids.append(ids[over])
            done_of.append(of[over])
            # The first place of the lowest rank in each piece that is not done.
            hit = np.flatnonzero((rank == np.repeat(best, length)) & ~over)
            hit = hit[np.concatenate([[True], of[hit][1:] != of[hit][:-1]])] if len(hit) else hit
            ids[hit] = rank[hit]
            keep = ~over
            keep[hit + 1] = False
            ids, of = ids[keep], of[keep]
        all_ids, all_of = np.concatenate([*done_ids, np.zeros(0, np.int64)]), np.concatenate([*done_of, np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(all_of, kind="stable")
        return all_ids[order], np.bincount(all_of, minlength=len(pieces))

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap over a linked list, in time near to the piece's length."""
        n = len(piece)
        ids = [int(x) for x in self.byte_rank[np.frombuffer(piece, np.uint8)]]
        text, nxt, prev = [piece[k : k + 1] for k in range(n)], [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, k) for k in range(n - 1) if (r := self.ranks.get(text[k] + text[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            j = nxt[k] if ids[k] >= 0 else -1
            if j < 0 or self.ranks.get(text[k] + text[j]) != rank:
                continue
            text[k], ids[k], ids[j], nxt[k] = text[k] + text[j], rank, -1, nxt[j]
            if nxt[k] >= 0:
                prev[nxt[k]] = k
            for a, b in ((prev[k], k), (k, nxt[k])):
                if a >= 0 and b >= 0 and (r := self.ranks.get(text[a] + text[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x in ids if x >= 0]

    def offsets(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where each id's bytes start in its text."""
        size = self.word_len[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        return (ends[:-1] - np.repeat(ends[before[:-1]], np.diff(before))).astype(np.uint32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        return self.word_bytes[ranges(self.word_at[ids], self.word_len[ids])]


@lru_cache(maxsize=4)
def encoder(rank_file: bytes) -> Encoder:
    return Encoder(rank_file)


def read_ranks(path: str) -> bytes:
    """A rank file: base64 of a token and its rank on each line."""
    with open(path, "rb") as file:
        return file.read()


def _encoded(batches: Iterator[pa.RecordBatch], own: Encoder, text: str) -> Iterator[pa.RecordBatch]:
    """The batches in passes, with ``n_tokens``, ``ids`` and ``offsets``."""
    for batch in passes(batches, text):
        raw, at = text_bytes(batch.column(text))
        ids, before = own.encode(raw, at)
        added = [pa.array(np.diff(before)), binary_array(ids.astype("<u4"), before), binary_array(own.offsets(ids, before).astype("<u4"), before)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "n_tokens", "ids", "offsets"])


def _decoded(batches: Iterator[pa.RecordBatch], own: Encoder, ids: str, offsets: str) -> Iterator[pa.RecordBatch]:
    """The batches in passes, with ``decoded``."""
    for batch in passes(batches, ids):
        raw, at = text_bytes(batch.column(ids))
        packed = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
        place, _ = text_bytes(batch.column(offsets))
        place, before = np.frombuffer(place.tobytes(), "<u4").astype(np.int64), at // 4
        size = own.word_len[packed]
        last = np.maximum(before[1:] - 1, 0)
        length = np.where(np.diff(before) > 0, place[last] + size[last], 0) if len(packed) else np.zeros(batch.num_rows, np.int64)
        out_at = np.concatenate([[0], np.cumsum(length)])
        out = np.zeros(out_at[-1], np.uint8)
        out[ranges(place + np.repeat(out_at[:-1], np.diff(before)), size)] = own.decode(packed)
        yield pa.RecordBatch.from_arrays([*batch.columns, binary_array(out, out_at)], names=[*batch.schema.names, "decoded"])


_ENCODED = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("offsets", T.BinaryType())]
_DECODED = [T.StructField("decoded", T.BinaryType())]


def _without(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    names = {f.name for f in fields}
    return df.drop(*(c for c in df.columns if c.lower() in names))


def encode(df: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens`` (long), ``ids`` and ``offsets`` (packed little-endian unsigned 32-bit integers).

    ``offsets`` holds where each id's bytes start in the text. Existing columns of these names are replaced. The
    vocabulary file (about 1 MB) is read on the driver and broadcast.
    """
    spark = task_session(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    df = _without(df, _ENCODED)
    return df.mapInArrow(lambda batches: _encoded(batches, encoder(ranks.value), text), T.StructType([*df.schema.fields, *_ENCODED]))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the packed ids, each placed at its offset. Null ids are empty."""
    spark = task_session(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    df = _without(df, _DECODED)
    return df.mapInArrow(lambda batches: _decoded(batches, encoder(ranks.value), ids, offsets), T.StructType([*df.schema.fields, *_DECODED]))


def round_trip(df: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``encode`` and then ``decode`` in the same tasks: with both as steps of their own, a core has two Python workers at
    a time, each with the vocabulary and a cache."""
    spark = task_session(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    df = _without(df, [*_ENCODED, *_DECODED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks.value)
        return _decoded(_encoded(batches, own, text), own, "ids", "offsets")

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *_ENCODED, *_DECODED]))


def digests(df: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``documents``: encoded, then decoded."""
    done = round_trip(df.select("doc_id", "text"), ranks_path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the digests of every whole text of ``documents``."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
