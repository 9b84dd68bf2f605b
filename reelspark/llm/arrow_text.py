"""Text columns as numpy arrays inside Arrow tasks: bytes, code points, words and word hashes, without a loop per row."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass covers; a longer text is a pass of its own.
PASS_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column, and where each row starts (one more entry at the end); null is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def passes(batches: Iterator[pa.RecordBatch], column: str, limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of ``column`` (one row at least), so that memory is bounded."""
    for batch in batches:
        _, at = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    _release()


def _release() -> None:
    """Gives freed memory back to the system at a task's end, as workers go on to other stages (where libc can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def binary_array(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column of the slices of ``data`` (any dtype) between successive entries of ``at`` (in items)."""
    size = np.asarray(at, np.int64) * data.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(size.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] of them), then the same for the next."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def word_spans(is_word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, which never cross a row's end."""
    if len(is_word) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:]
    inner = at[(at > 0) & (at < len(is_word))]
    begins[inner] = is_word[inner]
    ends[inner - 1] = is_word[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        power = np.full(size, base, np.uint64)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    room = PASS_BYTES + (1 << 16)
    while room < size:
        room *= 2
    return _powers(room)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: close inputs become unrelated."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64), 1)


class SpanHasher:
    """64-bit hashes of slices of bytes (or of any uint64 values), from prefix sums of a polynomial."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((_BYTE_VALUE[values] if values.dtype == np.uint8 else values) * power[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(values).of(starts, ends)


def lower_word_table() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: itself with A-Z in lower case, and whether it belongs to a word (a-z, 0-9, all beyond ASCII)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


LOWER, WORD = lower_word_table()


def lower_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the rows, the words' starts and ends in them, and how many words come before each row."""
    raw, at = text_bytes(column)
    data = LOWER[raw]
    starts, ends = word_spans(WORD[data], at)
    return data, starts, ends, np.searchsorted(starts, at)


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and where each one's bytes start."""
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw[starts].astype(np.int32)
    many = np.flatnonzero(points >= 0x80)
    if len(many):
        lead, at = points[many], starts[many]
        width = 1 + (lead >= 0xC0).astype(np.int8) + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.int32)[width]
        for k in (1, 2, 3):
            longer = width > k
            value[longer] = (value[longer] << 6) | (raw[at[longer] + k] & 0x3F)
        points[many] = value
    return points, starts


class HashIndex:
    """Numbers for distinct non-negative 64-bit keys, found for whole arrays at once (open addressing, load of a third at most)."""

    def __init__(self, bits: int = 12):
        self.bits, self.held = bits, 0
        self.key = np.full((1 << bits) + 1, -1, np.int64)
        self.value = np.full((1 << bits) + 1, -1, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it has none."""
        slot = self._slot(keys)
        held = self.key[slot]
        out = np.where(held == keys, self.value[slot], -1)
        go = np.flatnonzero((held != keys) & (held != -1))
        slot = slot[go]
        while len(go):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            held = self.key[slot]
            hit = held == keys[go]
            out[go[hit]] = self.value[slot[hit]]
            rest = ~hit & (held != -1)
            go, slot = go[rest], slot[rest]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that it does not hold yet, each given once."""
        if (self.held + len(keys)) * 3 > 1 << self.bits:
            old = self.key != -1
            keys, values = np.concatenate([self.key[old], keys]), np.concatenate([self.value[old], values])
            self.__init__(max(self.bits, int(np.ceil(np.log2(len(keys) * 4 + 1)))))
        self.held += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.key[slot] == -1)
            _, pick = np.unique(slot[free], return_index=True)
            put = free[pick]
            self.key[slot[put]], self.value[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
