"""Phrase collocations by Toivonen's sampling algorithm.

A phrase is frequent when it occurs ``support`` times in its language, and then all its parts are. A random sample of
the documents proposes words and phrases, at a lowered support. One pass over all documents then counts exactly what is
proposed and its negative border: the phrases that are not proposed themselves but all of whose parts are, which are all
words, and each longer phrase whose first and last n - 1 words are proposed. A border phrase that turns out frequent is a
failure of the sample: phrases that hold it were not counted. The failures join the proposals, and an expansion pass
counts the phrases that have come into reach, until there are no failures left; then every frequent phrase has been
counted, whatever the sample held. What an expansion pass meets for the first time it takes as proposed, so one is enough.

Proposals go to the tasks as Bloom filters, of eight bits for each proposal and at most ``2 ** MOST_BITS`` bits for a
length, so memory does not bound their number: a phrase let in by mistake is only counted in vain. Most of the border
is rare, so the first pass counts in two steps: by 64-bit hashes, then, of the phrases whose hash reaches the support (a
hash never counts less than its phrase), by the phrases as they are spelt. Every count in the result is of the latter
kind. Hashes go to Spark in runs, one row for those of a text slice that begin with the same ``RUN_BITS`` bits, which Spark
deals and sorts by these bits; the runs that come together are added up in slices. Counts are summed in each task over ``PASS_BYTES`` of text before Spark adds them up.

Words: ASCII letters are lower-cased, pieces end at . , ; : ! ? and line breaks, words at spaces and tabs; phrases don't
cross pieces. Each language is counted on its own.

Defined cases: a null language is ``und``; null, empty and wordless texts add nothing; repeated rows count again; ties in
the ranking go by phrase; an empty table has no phrases; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.llm.arrow_text import LOWER, binary_array, mix, passes, span_hashes, text_bytes, word_spans
from reelspark.llm.store import stored, task_session

SUPPORT, LONGEST = 10, 3
#: Share of the documents in the sample, and the least support in it as a share of what is expected at ``support``.
SAMPLE, LOWERED, SEED = 0.25, 0.8, 12
#: Bits of a filter as a power of two, at least and at most (32 MB).
LEAST_BITS, MOST_BITS = 16, 28
#: Bytes of text that are counted together.
PASS_BYTES = 2 << 20
#: Bits that the hashes of a run begin with, and hashes that are added up at once (and those of one beginning more).
RUN_BITS, RUN_HASHES = 12, 1 << 20
#: Rows of counts that go to Spark at once.
ROWS = 1 << 16
TOP = 2000

_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?\n\x0b\x0c\r"]] = True
_IN_WORD = ~_PIECE_ENDS
_IN_WORD[[*b" \t"]] = False

_FREQUENT = "lang string, n int, phrase string, hash long, proposed boolean, f long"
#: Bits of one value of bitmap_construct_agg.
_BITMAP = 32768


@dataclass
class Filters:
    """A Bloom filter (two bits a phrase) of the proposals of each length, from 1, of ``2 ** size`` bits each."""

    bits: list[np.ndarray]
    size: int

    def hold(self, length: int, hashes: np.ndarray) -> np.ndarray:
        bits = self.bits[length - 1]
        found = np.ones(len(hashes), bool)
        for place in (hashes >> np.uint64(64 - self.size), (hashes << np.uint64(self.size)) >> np.uint64(64 - self.size)):
            found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    def joined(self, other: Filters) -> Filters:
        return Filters([a | b for a, b in zip(self.bits, other.bits, strict=True)], self.size)


def filters_of(phrases: DataFrame, lengths: int, size: int) -> Filters:
    """The filters of the rows of ``phrases`` (n, hash); bits are set in Spark, so what arrives is bounded."""
    first = F.shiftrightunsigned("hash", 64 - size)
    second = F.shiftrightunsigned(F.shiftleft("hash", size), 64 - size)
    places = phrases.select("n", F.explode(F.array(first, second)).alias("place"))
    # Buckets of a bitmap count from 1 for places from 1.
    bitmaps = places.groupBy("n", F.bitmap_bucket_number(F.col("place") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bitmap"))
    out = [np.zeros(1 << (size - 3), np.uint8) for _ in range(lengths)]
    for batch in bitmaps.toArrow().to_batches():
        for n, bucket, bitmap in zip(batch.column("n").to_pylist(), batch.column("bucket").to_pylist(), batch.column("bitmap").to_pylist(), strict=True):
            at = (bucket - 1) * (_BITMAP // 8)
            out[n - 1][at : at + len(bitmap)] = np.frombuffer(bitmap, np.uint8)[: len(out[n - 1]) - at]
    return Filters(out, size)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer text is in a batch of its own."""
    held, size = [], 0
    for batch in passes(batches, column, limit):
        own = int(text_bytes(batch.column(column))[1][-1])
        if held and size + own > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _sent(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (rows.slice(k, ROWS) for k in range(0, rows.num_rows, ROWS))


def _unit(word: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """The hash of a word of a language, from those of both."""
    return mix(word ^ mix(lang, 3), 5)


def _grown(phrase: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    return mix(phrase * np.uint64(0x9E3779B97F4A7C15) ^ unit, 7)


def _hashes(column: pa.Array) -> np.ndarray:
    data, at = text_bytes(column)
    return span_hashes(data, at[:-1], at[1:])


def phrase_hashes(lang: pa.Array, phrase: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths (0 for the empty phrase) and hashes of phrases that are spelt out."""
    words = pc.split_pattern(phrase, " ")
    size = np.array(pc.list_value_length(words), np.int64)
    first = np.cumsum(size) - size
    unit = _unit(_hashes(words.flatten()), np.repeat(_hashes(lang), size))
    out = unit[first]
    for k in range(1, int(size.max(initial=0))):
        more = np.flatnonzero(size > k)
        out[more] = _grown(out[more], unit[first[more] + k])
    return np.where(np.array(pc.equal(phrase, "")), 0, size), out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key among the distinct ones, and how often each of those is there."""
    coded = pa.array(keys).dictionary_encode()
    number = np.array(coded.indices, np.int64)
    return number, np.bincount(number, minlength=len(coded.dictionary))


def _added(hashes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and how often each is there (one time for each place, or ``times``)."""
    if times is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes)
        hashes, times = hashes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.diff(np.append(first, len(hashes))) if times is None else np.add.reduceat(times, first) if len(first) else times


_RUNS = "n int, bucket int, hashes binary, times binary"


def _runs(n: int, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct hashes of a text slice and how often each is there, a row for each beginning that they have."""
    found, times = _added(hashes)
    bucket = (found >> np.uint64(64 - RUN_BITS)).astype(np.int32)
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(found) else np.zeros(1, np.int64)
    columns = [pa.array(np.full(len(at) - 1, n, np.int32)), pa.array(bucket[at[:-1]]), binary_array(found.astype("<u8"), at), binary_array(times.astype("<i8"), at)]
    yield pa.RecordBatch.from_arrays(columns, names=["n", "bucket", "hashes", "times"])


def _sums(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """n, hash of the hashes that are there ``least`` times, from runs in order of n and bucket."""

    def sums(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks().to_batches()
        for batch in rows:
            n, size = np.array(batch.column("n")), np.diff(text_bytes(batch.column("hashes"))[1]) // 8
            hashes, times = (np.frombuffer(text_bytes(batch.column(c))[0].tobytes(), kind) for c, kind in (("hashes", "<u8"), ("times", "<i8")))
            of = np.repeat(n, size)
            for k in np.unique(n).tolist():
                found, total = _added(hashes[of == k], times[of == k])
                found = found[total >= least].view(np.int64)
                yield from _sent(pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int32)), pa.array(found)], names=["n", "hash"]))

    held, size = None, 0
    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        size += len(text_bytes(batch.column("hashes"))[0]) // 8
        if size < RUN_HASHES:
            continue
        # The rows of the last beginning may go on in the next batch.
        place = np.array(held.column("n"), np.int64) << 32 | np.array(held.column("bucket"), np.int64)
        whole = int(np.searchsorted(place, place[-1]))
        if whole:
            yield from sums(held.slice(0, whole))
            held = held.slice(whole).combine_chunks()
            size = sum(len(text_bytes(b.column("hashes"))[0]) // 8 for b in held.to_batches())
    if held is not None:
        yield from sums(held)


def often(runs: DataFrame, least: int) -> DataFrame:
    """n, hash of what the rows of ``runs`` hold ``least`` times altogether."""
    dealt = runs.repartition("n", "bucket").sortWithinPartitions("n", "bucket")
    return dealt.mapInArrow(lambda batches: _sums(batches, least), "n int, hash long")


class Words:
    """The words of a batch in order, coded by language and word."""

    def __init__(self, batch: pa.RecordBatch):
        raw, at = text_bytes(batch.column("text"))
        data = LOWER[raw]
        inside = _IN_WORD[data]
        starts, ends = word_spans(inside, at)
        row = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, at)))
        breaks = np.concatenate([[0], np.cumsum(_PIECE_ENDS[data], dtype=np.int32)])
        piece = breaks[starts] + row
        #: Whether the next word is in the same piece.
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(starts) else np.zeros(0, bool)
        ends_at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        own = data[inside]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(own)]).dictionary_encode()
        self.word, self.words = np.array(words.indices, np.int64), words.dictionary
        langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
        self.lang, self.langs = np.array(langs.indices, np.int64)[row], langs.dictionary
        size = max(len(self.words), 1)
        #: Words of a language, as one number each.
        self.number, pairs = self._numbered(self.lang * size + self.word, len(self.langs) * size)
        self.hashes = _unit(_hashes(self.words)[pairs % size], _hashes(self.langs)[pairs // size])

    @staticmethod
    def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > 4 * len(keys) + 1024:  # many languages
            coded = pa.array(keys).dictionary_encode()
            return np.array(coded.indices, np.int64), np.array(coded.dictionary, np.int64)
        held = np.flatnonzero(np.bincount(keys, minlength=size))
        number = np.zeros(size, np.int64)
        number[held] = np.arange(len(held))
        return number[keys], held

    def levels(self, longest: int, counted: Filters | None, proposed: Filters | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: where the phrases begin whose parts are proposed (None: all are), their hashes, and whether
        earlier passes, with the filters in ``counted``, counted them. After the first pass, what was not counted
        before is as good as proposed."""
        begin, hashes = np.arange(len(self.word)), self.hashes[self.number]
        before = np.full(len(begin), counted is not None)
        for length in range(1, longest + 1):
            yield length, begin, hashes, before
            if length == longest:
                return
            alive_at, known_at, hash_at = np.zeros(len(self.word) + 1, bool), np.zeros(len(self.word) + 1, bool), np.zeros(len(self.word), np.uint64)
            alive_at[begin], hash_at[begin] = True, hashes
            if proposed is not None:
                alive_at[begin] = self._held(proposed, length, hashes)
            if counted is not None:
                alive_at[begin] |= ~before
                known_at[begin] = before & self._held(counted, length, hashes)
            begin = np.flatnonzero(alive_at[:-1] & alive_at[1:] & self.joined)
            hashes = _grown(hash_at[begin], self.hashes[self.number[begin + length]])
            before = known_at[begin] & known_at[begin + 1]

    def _held(self, filters: Filters, length: int, hashes: np.ndarray) -> np.ndarray:
        return filters.hold(1, self.hashes)[self.number] if length == 1 else filters.hold(length, hashes)

    def counts(self, length: int, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each distinct phrase of those that begin there is first, and how often it is there."""
        same = self.number[begin]
        for k in range(1, length):
            same = _distinct(same * len(self.hashes) + self.number[begin + k])[0]
        number, count = _distinct(same)
        first = np.empty(len(count), np.int64)
        first[number[::-1]] = begin[::-1]
        return first, count

    def spell(self, length: int, begin: np.ndarray) -> pa.Array:
        """The words of phrases, a tab (which no word holds) and the language."""
        words = [self.words.take(pa.array(self.word[begin + k])) for k in range(length)]
        whole = words[0] if length == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))
        return self._tabbed(whole, self.lang[begin])

    def totals(self) -> tuple[pa.Array, np.ndarray]:
        """The empty phrase of each language, with the number of its words."""
        langs = np.arange(len(self.langs))
        return self._tabbed(pa.array([b""] * len(langs), pa.large_binary()), langs), np.bincount(self.lang, minlength=len(langs))

    def _tabbed(self, phrase: pa.Array, lang: np.ndarray) -> pa.Array:
        langs = self.langs.cast(pa.large_binary()).take(pa.array(lang))
        return pc.binary_join_element_wise(phrase, langs, pa.scalar(b"\t", pa.large_binary())).cast(pa.binary()).cast(pa.string())


def propose(docs: DataFrame, support: int, longest: int, fraction: float) -> Filters:
    """What the sample holds often enough; the longest phrases need no proposals, as nothing is built from them."""
    least = max(2 if fraction < 1 else support, int(LOWERED * support * fraction))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", PASS_BYTES):
            for length, _, hashes, _ in Words(batch).levels(longest - 1, None, None):
                yield from _runs(length, hashes)

    some = docs if fraction >= 1 else docs.sample(fraction, SEED)
    return sized_filters(often(some.mapInArrow(run, _RUNS), least), longest - 1)


def sized_filters(phrases: DataFrame, lengths: int) -> Filters:
    """The filters of the rows of ``phrases`` (n, hash), as large as their number asks for."""
    found = stored(phrases.select("n", "hash"), "hashes")
    most = found.groupBy("n").count().agg(F.max("count")).first()[0] or 0
    return filters_of(found, lengths, min(max((8 * most).bit_length(), LEAST_BITS), MOST_BITS))


def likely(docs: DataFrame, support: int, longest: int, proposed: Filters) -> Filters:
    """What the proposals and their border hold often enough by their hashes, all lengths together."""
    sent = docs.sparkSession.sparkContext.broadcast(proposed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", PASS_BYTES):
            yield from _runs(1, np.concatenate([hashes for _, _, hashes, _ in Words(batch).levels(longest, None, sent.value)]))

    return sized_filters(often(docs.mapInArrow(run, _RUNS), support), 1)


def count(docs: DataFrame, support: int, longest: int, counted: Filters | None, proposed: Filters) -> DataFrame:
    """lang, n, phrase, hash, proposed, f of the frequent phrases among the proposals and their border that earlier
    passes (``counted``) did not count; in the first pass also each language's words altogether, as length 0."""
    proposes = longest if counted is None else 1
    some_hashes = likely(docs, support, longest, proposed) if counted is None else None
    sent = docs.sparkSession.sparkContext.broadcast((counted, proposed, some_hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, proposed, some_hashes = sent.value
        for batch in gathered(batches, "text", PASS_BYTES):
            words = Words(batch)
            if counted is None:
                yield pa.RecordBatch.from_arrays([*map(pa.array, words.totals())], names=["key", "f"])
            for length, begin, hashes, before in words.levels(longest, counted, proposed):
                first, times = words.counts(length, begin[~before if some_hashes is None else some_hashes.hold(1, hashes)])
                yield from _sent(pa.RecordBatch.from_arrays([words.spell(length, first), pa.array(times)], names=["key", "f"]))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pc.split_pattern(batch.column("key"), "\t", max_splits=1)
            phrase, lang = pc.list_element(parts, 0), pc.list_element(parts, 1)
            size, hashes = phrase_hashes(lang, phrase)
            held = np.ones(len(size), bool)
            for n in range(1, proposes):
                own = np.flatnonzero(size == n)
                held[own] = sent.value[1].hold(n, hashes[own])
            yield pa.RecordBatch.from_arrays([lang, pa.array(size.astype(np.int32)), phrase, pa.array(hashes.view(np.int64)), pa.array(held), batch.column("f")], names=["lang", "n", "phrase", "hash", "proposed", "f"])

    each = docs.mapInArrow(run, "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))
    return each.where((F.col("f") >= support) | F.col("key").startswith("\t")).mapInArrow(describe, _FREQUENT)


def mine(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, fraction: float = SAMPLE, text: str = "text", lang: str = "lang") -> tuple[DataFrame, int]:
    """lang, n, phrase, f of every phrase of up to ``longest`` words that occurs ``support`` times in its language, and
    of length 0 each language's number of words; and how many passes over all documents that took."""
    if longest < 2 or support < 1 or not 0 < fraction <= 1:
        raise ValueError("phrases of two words at least, a support of one at least, a share of the documents above 0")
    task_session(docs.sparkSession)
    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counted, proposed = None, propose(own, support, longest, fraction)
    frequent, steps = None, 0
    while True:
        found = stored(count(own, support, longest, counted, proposed), "phrases")
        frequent, steps = found if frequent is None else frequent.unionByName(found), steps + 1
        failures = found.where((F.col("n") > 0) & (F.col("n") < longest) & ~F.col("proposed"))
        if failures.isEmpty():
            return frequent.select("lang", "n", "phrase", "f"), steps
        counted, proposed = proposed, proposed.joined(filters_of(failures, longest - 1, proposed.size))


def _part(first: F.Column | int, number: F.Column | int) -> F.Column:
    return F.array_join(F.slice("words", first, number), " ")


def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by the score of their weakest cut.

    A phrase's occurrences a are set against those of its two parts, l and r: floor(10^6 a^2 / (l r)), in whole numbers
    of up to 38 digits. Phrases that occur in one longer phrase for half of their occurrences or more are left out.
    """
    phrases = frequent.where("n >= 2").select("lang", "phrase", "n", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    parts = frequent.where("n >= 1").select("lang", F.col("phrase").alias("part"), "f")
    cuts = phrases.select("lang", "phrase", "n", "a", "words", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("front"), _part(F.col("k") + 1, F.col("n") - F.col("k")).alias("back"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("front"), F.col("f").alias("l")), ["lang", "front"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("back"), F.col("f").alias("r")), ["lang", "back"])
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    cuts = cuts.withColumn("above", (wide("a") * wide("a") * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)")).withColumn("below", (wide("l") * wide("r")).cast("decimal(38,0)"))
    least = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # What a phrase two words longer holds, one of the phrases between holds as often, so one word more is enough.
    inner = F.explode(F.array(_part(1, F.col("n") - 1), _part(2, F.col("n") - 1))).alias("phrase")
    longer = phrases.where("n >= 3").select("lang", F.col("a").alias("f"), "words", "n").select("lang", "f", inner).groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < 50 * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = frequent.where("n = 0").select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the best collocations of two and three words of each language of ``documents``."""
    frequent, _ = mine(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return collocations(frequent)


OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT lang, row_number() OVER () p, regexp_extract_all(piece, '[^\x20\x09]+') w FROM pieces),
words AS (SELECT lang, p, unnest(w) x, unnest(range(len(w))) i FROM numbered),
runs AS (SELECT lang, x, lead(x) OVER s y, lead(x, 2) OVER s z FROM words WINDOW s AS (PARTITION BY p ORDER BY i)),
one AS (SELECT lang, x, count(*) f FROM runs GROUP BY ALL),
two AS (SELECT lang, x, y, count(*) f FROM runs WHERE y IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, x, y, z, count(*) f FROM runs WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= {SUPPORT}),
cuts AS (
  SELECT lang, t.x || ' ' || t.y phrase, t.f a, 1 k, p.f l, q.f r
  FROM two t JOIN one p USING (lang, x) JOIN one q ON q.lang = t.lang AND q.x = t.y WHERE t.f >= {SUPPORT}
  UNION ALL
  SELECT lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f
  FROM three t JOIN one p USING (lang, x) JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f
  FROM three t JOIN two p USING (lang, x, y) JOIN one q ON q.lang = t.lang AND q.x = t.z),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) score FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) f FROM (
    SELECT lang, x || ' ' || y phrase, f FROM three UNION ALL SELECT lang, y || ' ' || z, f FROM three) GROUP BY ALL),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100 * longer.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, (SELECT count(*) FROM words WHERE words.lang = ranked.lang) n, CAST(score AS BIGINT) score
FROM ranked WHERE rank <= {TOP}
"""
