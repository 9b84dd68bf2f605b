"""Token ids in a compressed file format, by an adaptive context-mixing range coder.

The ids of all documents, in ascending order of ``doc_id``, are one stream that is cut into blocks of ``BLOCK`` ids, and
a segment has up to ``LANES`` blocks or what its last documents bring. Blocks are coded side by side, a numpy lane for each,
and have a checksum each; their models are shared by the segment's lanes and start anew with it, so segments are read
independently. The last ids seen after the same one and the same two ids predict the next one (orders 1 and 2), with a
confidence that says how often the prediction has been right lately. For either there is an expert, whose
probabilities of a hit depend on its confidence and whether the two agree, and a weight that follows the better expert mixes
them. What neither order predicts is coded by order 0: an adaptive distribution over classes of ids, then the id's
place in its class. All probabilities drive one range coder of 48 bits in whole numbers, held in doubles (all are below 2**53,
and so are exact, as are the quotients rounded down), so that any machine decodes the same.

A file holds segments: rows of Parquet with the documents' ids and lengths, and the coded blocks. Files are in order,
and so are the segments in a file, so that a document's place in the stream is what comes before it.

Defined cases: a null or empty text is its end id alone; a null ``doc_id`` comes first; rows of one ``doc_id`` are in order
of their texts; an empty table gives an empty store; a block whose checksum is wrong raises ``ValueError``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.llm.arrow_text import PASS_BYTES, binary_array, passes, ranges, text_bytes
from reelspark.llm.bpe import PieceCache
from reelspark.llm.store import new_path, task_session

#: Ids in a block, and blocks that are coded side by side.
BLOCK = 1024
LANES = 2048
SEGMENT = BLOCK * LANES
END_ID = 0
#: Pieces that go to the library as one list of words.
RUN = 1000
#: Places for what follows two ids, and ids that can be coded.
_SLOTS, _IDS = 1 << 18, 1 << 17
#: Pieces in a worker's cache (see PieceCache).
_ROOM = 600_000
#: Steps after which the probabilities take in what was seen; after fewer at the start.
_REFRESH = 16
#: Counts of an expert's context beyond which they are halved.
_LIMIT = 1 << 16
#: The width at first, and the one up to which a word is written.
_FULL, _SMALL = 2.0**48, 2.0**32
# Classes of order 0: each id below 512, from there on 64 for each number of bits; an id is its class's first and a tail.
_EACH = np.arange(_IDS)
_TAIL = np.maximum(np.array([k.bit_length() for k in range(_IDS)]) - 7, 0) * (_EACH >= 512)
_KIND = np.where(_EACH < 512, _EACH, 448 + (_TAIL - 3) * 64 + (_EACH >> _TAIL))
_BASE = np.append(np.flatnonzero(np.diff(_KIND, prepend=-1)), 0).astype(np.int32)
_CLASSES = len(_BASE) - 1
_SCALE = 2.0 ** -_TAIL[_BASE[:-1]].astype(float)
_NULL = np.iinfo(np.int64).min


class Models:
    """The models that all lanes of a segment share, in whole numbers."""

    def __init__(self, lanes: int):
        self.table = np.zeros(_SLOTS + _IDS, np.int32)  # id * 4 + confidence: by the last two ids, then by the last one
        self.index = np.zeros((2, lanes), np.int64)
        self.one = np.zeros(lanes, np.int32)
        self.at = np.zeros(lanes, np.int64)
        self.two = np.zeros(lanes, np.int32)
        # How often order 2 was right, only order 1, or neither: by an expert's own confidence and whether they agree.
        self.seen = [np.tile(np.array([2, 2, 16]), (4, 2, 1)) for _ in range(2)]
        self.weight = np.full((4, 4, 2), 8)  # by the confidence of order 2, that of order 1, and whether they agree
        self.kinds = np.ones(_CLASSES, np.int64)  # of order 0
        self.new_hits, self.new_kinds = np.zeros(96, np.int64), np.zeros(_CLASSES + 1, np.int64)
        self.start, self.share = np.zeros(_CLASSES + 1), np.full(_CLASSES + 1, 32768.0)  # the last one: no class is coded
        self.step = 0
        self._refresh()

    def _refresh(self) -> None:
        """Takes in what was seen since the last time."""
        hits = self.new_hits.reshape(4, 4, 2, 3)
        if self.step:
            apart = self.said[0][:, None] - self.said[1][None]
            self.weight = np.clip(self.weight + np.sign((hits * apart).sum(axis=3)), 1, 15)
        for k in range(2):
            seen = self.seen[k] + hits.sum(axis=1 - k)
            self.seen[k] = np.where(seen.sum(axis=2, keepdims=True) > _LIMIT, (seen >> 1) + 1, seen)
        self.said = [(seen << 12) // seen.sum(axis=2, keepdims=True) for seen in self.seen]
        by_two, by_one = self.said[0][:, None], self.said[1][None]
        mixed = by_one + ((by_two - by_one) * self.weight[..., None] >> 4)
        two = np.maximum(mixed[..., 0], 16)
        both = np.minimum(two + np.maximum(mixed[..., 1], 16), 4096 - 64)
        ends = np.stack([np.zeros_like(two), np.minimum(two, both - 16), both, np.full_like(two, 4096)], axis=-1).astype(float)
        self.two_end, self.both_end = np.repeat(ends[..., 1].ravel(), 3), np.repeat(ends[..., 2].ravel(), 3)
        self.hit_start, self.hit_share = ends[..., :-1].ravel(), np.diff(ends).ravel()
        self.kinds += self.new_kinds[:-1] * 24
        if self.kinds.sum() > _LIMIT << 8:
            self.kinds = (self.kinds >> 1) + 1
        share = 1 + self.kinds * (32768 - _CLASSES) // self.kinds.sum()
        share[share.argmax()] += 32768 - share.sum()
        self.start[1:-1], self.share[:-1] = np.cumsum(share[:-1]), share * _SCALE
        self.kind_at = np.repeat(np.arange(_CLASSES), share)
        self.new_hits[:], self.new_kinds[:] = 0, 0

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids that orders 2 and 1 predict, and where the mixed probabilities are: a hit of order 2, only of order 1, of none."""
        mixed = self.one * np.int32(-1640531535) + self.two * np.int32(-2048144789)  # 32 bits, wrapping alike everywhere
        np.bitwise_and(mixed >> 13, _SLOTS - 1, out=self.index[0])
        np.add(self.one, _SLOTS, out=self.index[1])
        self.held = self.table.take(self.index, mode="clip")
        self.trust, said = self.held & 3, self.held >> 2
        at = self.at
        np.multiply(self.trust[0], 24, out=at)
        at += self.trust[1] * 6
        at += (said[0] == said[1]) * 3
        return said, at

    def learn(self, ids: np.ndarray, right: np.ndarray, at: np.ndarray, kind: np.ndarray) -> None:
        """Where order 2 and order 1 predicted the id, the place of what came, and the class of order 0 where none did."""
        self.new_hits += np.bincount(at, minlength=96)
        self.new_kinds += np.bincount(kind, minlength=_CLASSES + 1)
        # A confidence grows while the prediction is right; where lanes meet in a place, the last one stays.
        trust = np.minimum(self.trust + np.int32(1), np.int32(3))
        trust *= right
        trust += ids << 2
        self.table[self.index] = trust
        self.one, self.two = ids, self.one
        self.step += 1
        if self.step % _REFRESH == 0 or self.step < _REFRESH and self.step & (self.step - 1) == 0:
            self._refresh()


def _turned(grid: np.ndarray) -> np.ndarray:
    """The transposed grid, copied a few lines at a time, as they share cache lines."""
    out = np.empty(grid.shape[::-1], grid.dtype)
    for k in range(0, len(grid), 16):
        out[:, k : k + 16] = grid[k : k + 16].T
    return out


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit words of the blocks of a stream one after the other, and how many each block has."""
    lanes = -(-len(ids) // BLOCK)
    grid = np.zeros((lanes, BLOCK), np.int32)
    grid.ravel()[: len(ids)] = ids
    grid = _turned(grid)
    steps = min(BLOCK, len(ids)) if lanes == 1 else BLOCK
    models = Models(lanes)
    low, width = np.zeros(lanes), np.full(lanes, _FULL)
    room = steps * 3 + 8
    out, used = np.zeros(lanes * room, np.uint32), np.arange(lanes) * room
    for step in range(steps):
        now = grid[step]
        said, at = models.predict()
        right = said == now
        known = right[0] | right[1]
        at += 2
        at -= known
        at -= right[0]
        part = np.floor(width * 2.0**-12)
        low += part * models.hit_start.take(at, mode="clip")
        width = part * models.hit_share.take(at, mode="clip")
        kind = _KIND.take(now, mode="clip")
        rest = now - _BASE.take(kind, mode="clip")
        np.putmask(kind, known, _CLASSES)
        np.putmask(rest, known, 0)
        part = np.floor(width * 2.0**-15)
        low += part * models.start.take(kind, mode="clip")
        width = np.floor(part * models.share.take(kind, mode="clip"))
        low += width * rest
        # Writes the upper word where the width is small; a carry stays in the word's 17th bit until the end.
        word = np.floor(low * 2.0**-32)
        out[used] = word.astype(np.uint32)
        short = width <= _SMALL
        used += short
        low = np.where(short, (low - word * _SMALL) * 65536.0, low)
        width = np.where(short, width * 65536.0, width)
        more = np.flatnonzero(width <= _SMALL)
        while len(more):
            word = np.floor(low[more] * 2.0**-32)
            out[used[more]] = word
            used[more] += 1
            low[more] = (low[more] - word * _SMALL) * 65536.0
            width[more] *= 65536.0
            more = more[width[more] <= _SMALL]
        models.learn(now, right, at, kind)
    # Two words suffice for a value from which on 2**16 others lie within the width.
    last = np.ceil(low * 2.0**-16)
    out[used] = np.floor(last * 2.0**-16)
    out[used + 1] = last % 65536.0
    size = used + 2 - np.arange(lanes) * room
    words = out[ranges(np.arange(lanes) * room, size)]
    while len(over := np.flatnonzero(words >> 16)):
        np.add.at(words, over - 1, 1)
        words[over] -= 1 << 16
    return words.astype(np.uint16), size


def decode_blocks(words: np.ndarray, size: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` ids of a stream from its blocks' words."""
    lanes = len(size)
    steps = min(BLOCK, count) if lanes == 1 else BLOCK
    words = np.append(words, np.zeros(8, np.uint16))
    used = np.cumsum(size) - size
    value = words[used] * 2.0**32 + words[used + 1] * 2.0**16 + words[used + 2]
    used = used + 3
    width = np.full(lanes, _FULL)
    models = Models(lanes)
    grid = np.zeros((steps, lanes), np.int32)
    for step in range(steps):
        said, at = models.predict()
        part = np.floor(width * 2.0**-12)
        known = value < part * models.both_end.take(at, mode="clip")
        is_two = value < part * models.two_end.take(at, mode="clip")
        at += 2
        at -= known
        at -= is_two
        value -= part * models.hit_start.take(at, mode="clip")
        width = part * models.hit_share.take(at, mode="clip")
        part = np.floor(width * 2.0**-15)
        kind = models.kind_at.take((value / part).astype(np.int64), mode="clip")
        np.putmask(kind, known, _CLASSES)
        value -= part * models.start.take(kind, mode="clip")
        width = np.floor(part * models.share.take(kind, mode="clip"))
        rest = np.floor(value / width)
        value -= rest * width
        now = _BASE.take(kind, mode="clip") + rest.astype(np.int32)
        np.copyto(now, said[1], where=known)
        np.copyto(now, said[0], where=is_two)
        short = width <= _SMALL
        value = np.where(short, value * 65536.0 + words.take(used, mode="clip"), value)
        used += short
        width = np.where(short, width * 65536.0, width)
        more = np.flatnonzero(width <= _SMALL)
        while len(more):
            value[more] = value[more] * 65536.0 + words.take(used[more], mode="clip")
            used[more] += 1
            width[more] *= 65536.0
            more = more[width[more] <= _SMALL]
        models.learn(now, said == now, at, kind)
        grid[step] = now
    return _turned(grid).ravel()[:count]


class LibraryEncoder(PieceCache):
    """The tokenizers library; each distinct piece of text goes to it once, and whole each text that holds an added token.

    ``ordinary``: names of special tokens in a text are ordinary text; else they are their ids, as by the library's defaults.
    """

    room = _ROOM

    def __init__(self, tokenizer: str, ordinary: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = ordinary
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # the vocabulary spells a byte as a character
        self.bytes_of[np.fromiter(vocabulary.values(), np.int64, len(vocabulary))] = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and not (ordinary and t.special)]

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Goes to the library in runs of pieces, whose ids are parted again by the bytes that each stands for."""
        texts = [p.decode() for p in pieces]
        runs = [texts[k : k + RUN] for k in range(0, len(texts), RUN)]
        found = self.tokenizer.encode_batch_fast(runs, is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int64), *(np.array(e.ids, np.int64) for e in found)])
        reach = np.cumsum(self.bytes_of[ids])
        ends = np.cumsum([len(p) for p in pieces])
        before = np.searchsorted(reach, ends) + 1
        if len(reach) != before[-1] or (reach[before - 1] != ends).any():  # ids that do not stand for their own bytes
            return self._library(texts)
        return ids, np.diff(before, prepend=0)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((x for ids in found for x in ids), np.int64, int(count.sum())), count

    def encode_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after the other, and how many come before each."""
        held = np.zeros(len(column), bool)
        for token in self.added:
            held |= np.array(pc.match_substring(column, token).fill_null(False))
        if not held.any():
            return self.encode(*text_bytes(column))
        ids, before = self.encode(*text_bytes(pc.if_else(pa.array(held), "", column)))
        whole, count = self._library(column.filter(pa.array(held)).to_pylist())
        ids = np.insert(ids, np.repeat(before[:-1][held], count), whole)
        more = np.zeros(len(column), np.int64)
        more[held] = count
        return ids, before + np.concatenate([[0], np.cumsum(more)])


@lru_cache(maxsize=2)
def library_encoder(tokenizer: str, ordinary: bool) -> LibraryEncoder:
    return LibraryEncoder(tokenizer, ordinary)


#: ``file`` and ``segment`` give the order; ``doc_ids`` (long) and ``lengths`` (int) are of its documents, ``sizes`` (int)
#: and ``checksums`` (unsigned int) of its blocks, whose 16-bit words are ``words``.
SEGMENT_SCHEMA = "file long, segment long, n_ids long, doc_ids binary, lengths binary, sizes binary, checksums binary, words binary"


def _segment(number: int, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    words, size = encode_blocks(ids)
    ends = np.cumsum(size)
    checks = np.array([zlib.crc32(words[b - n : b]) for b, n in zip(ends.tolist(), size.tolist(), strict=True)], np.uint32)
    own = [doc_ids.astype("<i8"), lengths.astype("<i4"), size.astype("<i4"), checks.astype("<u4"), words.astype("<u2")]
    values = [TaskContext.get().partitionId(), number, len(ids), *(x.tobytes() for x in own)]
    names = [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in values], names=names)


def write(docs: DataFrame, tokenizer_path: str, path: str, doc_id: str = "doc_id", text: str = "text", ordinary: bool = True) -> None:
    """Tokenises all whole texts, appends the end id to each, and writes the files to ``path``.

    Names of the tokenizer's special tokens in a text are ordinary text, or their ids unless ``ordinary``.
    """
    spark = task_session(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = library_encoder(sent.value, ordinary), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in passes(batches, "text", PASS_BYTES // 2):
            ids, before = own.encode_texts(batch.column("text"))
            length = np.diff(before) + 1
            held.append((np.array(batch.column("doc_id").fill_null(_NULL), np.int64), length, np.insert(ids, before[1:], END_ID)))
            if sum(len(x) for _, _, x in held) >= SEGMENT:
                yield _segment(number, *(np.concatenate(x) for x in zip(*held, strict=True)))
                held, number = [], number + 1
        if held:
            yield _segment(number, *(np.concatenate(x) for x in zip(*held, strict=True)))

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # A text's beginning parts the rows of one id without taking whole texts for bounds; within a part whole texts decide.
    own.repartitionByRange("doc_id", F.left("text", F.lit(256))).sortWithinPartitions("doc_id", "text").mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens (with the end id), ids (packed, as unsigned 32 bits)."""
    task_session(spark)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One number for each file comes first, then one for each segment of a file.
    files = segments.groupBy("file").agg(F.sum("n_ids").alias("n")).withColumn("before_file", F.sum("n").over(Window.orderBy("file")) - F.col("n"))
    in_file = segments.select("file", "segment", "n_ids").withColumn("before", F.sum("n_ids").over(Window.partitionBy("file").orderBy("segment")) - F.col("n_ids"))
    placed = in_file.join(files.select("file", "before_file"), "file").select("file", "segment", (F.col("before") + F.col("before_file")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)  # noqa: B023, E731
                words, size, checks = get("words", "<u2"), get("sizes", "<i4").astype(np.int64), get("checksums", "<u4")
                for k, (b, n) in enumerate(zip(np.cumsum(size).tolist(), size.tolist(), strict=True)):
                    if zlib.crc32(words[b - n : b]) != checks[k]:
                        raise ValueError(f"block {k} of segment {batch.column('segment')[row]} of file {batch.column('file')[row]} is damaged")
                ids = decode_blocks(words, size, batch.column("n_ids")[row].as_py()).astype("<u4")
                doc_ids, length = get("doc_ids", "<i8"), get("lengths", "<i4").astype(np.int64)
                at = np.concatenate([[0], np.cumsum(length)])
                out = [pa.array(doc_ids, mask=doc_ids == _NULL), pa.array(at[:-1] + batch.column("base")[row].as_py()), pa.array(length), binary_array(ids, at)]
                whole = pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "n_tokens", "ids"])
                yield from passes(iter([whole]), "ids", 4 << 20)

    return segments.join(placed, ["file", "segment"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's place, length and checksum in the store of all whole texts, read back from its files.

    The ids are those of the tokenizers library at its defaults: a special token's name in a text is its id.
    """
    import public_tokenizers

    path = new_path(spark, "tokens")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), path, ordinary=False)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
