"""Near-duplicate documents by order MinHash.

A text's k-mers are its runs of five lower-case words, each labelled with its occurrence (the second time a k-mer is
met it is another one). A sketch takes the few k-mers of the smallest hashes under one of several hash functions and
keeps them in the order of the text, so that two texts share a sketch when they share these k-mers in this order.
Texts that share one are candidates. They are verified by alignment: the longest chain of common k-mers, in the
order of both texts, within the band that the threshold leaves (so many k-mers may be missing on either side).
With n and m k-mers and a chain of c the similarity is c / (n + m - c), and texts are linked from 0.8 on. Classes
are the connected components of the links.

Copies (texts of the same words in the same order) are one text from the start. In a bucket of a sketch every text
is first compared with the bucket's most central one, whose sketches are shared the most. What is linked with it
needs no comparison among itself, as the class is settled. A text that differs from it may still be linked with
another text of the bucket, of another class so far. Against the centre l, let e be the k-mers that a text has more
and m those that it lacks. Two texts x and y that share s of their additional k-mers differ in at least
e_x + e_y - 2s + |m_x - m_y| k-mers, and linked texts differ in (n_x + n_y)/9 at most. So only pairs are aligned
that share enough additional k-mers (an equality join) or whose e and m alone allow a link. No link is lost, and the
pairs of a large group of near copies stay about as many as its members.

Defined cases: a text of one to four words is one k-mer; texts without a word are copies where they are equal,
and alike to nothing else; null texts and rows with a null id are classes of their own; repeated rows share a class.
An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm.arrow_text import lower_words, mix, passes, span_hashes, text_bytes
from reelspark.llm.graph import components
from reelspark.llm.store import stored, task_session

K = 5
SIMILARITY = 0.8
#: Sketches of a text, and k-mers in a sketch. Texts alike to 0.8 miss each other in all with a chance of about 1e-5.
SKETCHES = 16
ORDER = 3

_MULTIPLIERS = mix(np.arange(1, 257, dtype=np.uint64), 8) | np.uint64(1)
_STEPS = mix(np.arange(1, 65, dtype=np.uint64), 9) | np.uint64(1)


def labelled_kmers(column: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' occurrence-labelled k-mers in the order of the text, and how many come before each row."""
    data, starts, ends, before = lower_words(column)
    words = span_hashes(data, starts, ends)
    n = np.diff(before)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    first = np.arange(at[-1]) - at[row] + before[row]
    length = np.minimum(n, k)[row]
    padded = np.append(words, np.zeros(k, np.uint64))
    hashes = np.zeros(len(first), np.uint64)
    for j in range(k):
        hashes += np.where(j < length, padded[first + j] * _STEPS[j], np.uint64(0))
    hashes = mix(hashes, 3)
    if len(hashes):
        order = np.lexsort((hashes, row))
        same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
        place = np.arange(len(order))
        run = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), place, 0))
        nth = np.zeros(len(order), np.uint64)
        nth[order] = (place - run).astype(np.uint64)
        hashes = mix(hashes + nth * _STEPS[60], 4)
    return hashes, at


def sketches(hashes: np.ndarray, at: np.ndarray, number: int = SKETCHES, order: int = ORDER) -> np.ndarray:
    """A row of ``number`` sketches for each text that has a k-mer, in the order of the texts (0 for those without)."""
    out = np.zeros((len(at) - 1, number), np.uint64)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    head, size = at[full], np.diff(at)[full]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    of = np.repeat(np.arange(len(full)), size)
    for s in range(number):
        value = hashes * _MULTIPLIERS[s]
        value ^= value >> np.uint64(32)
        place = np.full((len(full), order), len(hashes))
        for k in range(order):
            least = np.minimum.reduceat(value, head)
            hit = np.flatnonzero(value == least[of])
            hit = hit[least[of[hit]] != top]
            hit = hit[np.concatenate([[True], of[hit][1:] != of[hit][:-1]])] if len(hit) else hit
            place[of[hit], k] = hit
            value[hit] = top
        place.sort(axis=1)
        kept = np.append(hashes, np.uint64(0))[place]
        key = np.full(len(full), s + 1, np.uint64)
        for k in range(order):
            key = mix(key * _STEPS[k + 8] + kept[:, k], 5)
        out[full, s] = key
    return out


def chain(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> tuple[int, int]:
    """How many k-mers a and b have in common, and the longest chain of them in both orders within the band.

    A chain that reaches the similarity leaves at most (n + m)(1 - s)/(1 + s) k-mers unmatched, so no matched k-mer
    lies farther than that from the diagonal. Where too few are common for it, the chain is not searched (0).
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common, total = len(i), len(a) + len(b)
    if common < similarity * (total - common) - 1e-9:
        return common, 0
    band = int(total * (1 - similarity) / (1 + similarity)) + 1
    near = np.abs(i - j) <= band
    tails: list[int] = []
    for x in i[near][np.argsort(j[near])].tolist():
        at = bisect_left(tails, x)
        tails[at : at + 1] = [x]
    return common, len(tails)


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key_a and key_b (equal for copies; null for a null text), n (k-mers), sketches (empty where n is 0)."""
    task_session(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            column = batch.column("text")
            raw, at = text_bytes(column)
            hashes, k_at = labelled_kmers(column)
            n = np.diff(k_at)
            value = np.zeros((batch.num_rows, 2), np.int64)
            for part in range(2):
                of_kmers = span_hashes(mix(hashes, 11 + part), k_at[:-1], k_at[1:])
                of_text = mix(span_hashes(mix(raw.astype(np.uint64), 13 + part), at[:-1], at[1:]), 15)
                value[:, part] = np.where(n > 0, of_kmers, of_text).view(np.int64)
            null = np.array(pc.is_null(column))
            found = sketches(hashes, k_at).view(np.int64)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(n > 0, SKETCHES, 0))]).astype(np.int32), pa.array(found[n > 0].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value[:, 0], mask=null), pa.array(value[:, 1], mask=null), pa.array(n), lists], names=["doc_id", "key_a", "key_b", "n", "sketches"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, key_a long, key_b long, n long, sketches array<long>")


_ALIGNED = "a long, b long, n_a long, n_b long, common long, linked boolean, extra array<long>"


def _align(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs' k-mers, how many they have in common, whether they are linked, and the k-mers that only b has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(passes(batches, "text_a"), "text_b"):
            _, once, of = np.unique(np.array(batch.column("a")), return_index=True, return_inverse=True)
            left, left_at = labelled_kmers(batch.column("text_a").take(pa.array(once)))
            right, right_at = labelled_kmers(batch.column("text_b"))
            found, extra = np.zeros((batch.num_rows, 4), np.int64), []
            for row, k in enumerate(of.tolist()):
                x, y = left[left_at[k] : left_at[k + 1]], right[right_at[row] : right_at[row + 1]]
                common, longest = chain(x, y, similarity)
                found[row] = len(x), len(y), common, longest > 0 and longest >= similarity * (len(x) + len(y) - longest) - 1e-9
                extra.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(e) for e in extra])]).astype(np.int32), pa.array(np.concatenate([*extra, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, found.T[:3].copy()), pa.array(found[:, 3] > 0), lists], names=["a", "b", "n_a", "n_b", "common", "linked", "extra"])

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
    return with_both.mapInArrow(run, _ALIGNED)


def _bucket_pairs(sketched: DataFrame) -> DataFrame:
    """a (the most central text of a bucket) and b for every other text of the bucket."""
    texts = sketched.select("doc_id", F.explode("sketches").alias("bucket"))
    shared = texts.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(texts.join(shared, "bucket"), "buckets")
    central = members.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    centres = members.join(central, "doc_id").groupBy("bucket").agg((-F.max(F.struct("weight", -F.col("doc_id")))["col2"]).alias("a"))
    return members.join(centres, "bucket").select("a", F.col("doc_id").alias("b")).where("a <> b").distinct()


def _further_pairs(aligned: DataFrame, similarity: float) -> DataFrame | None:
    """Pairs a < b of texts that share a centre and no class yet, which their k-mers beside the centre's let be linked."""
    odd = aligned.where("NOT linked").select("a").distinct()
    near = aligned.join(odd, "a", "left_semi")
    if near.isEmpty():
        return None
    label = components(aligned.where("linked").select("a", "b"))
    near = near.join(label.withColumnRenamed("node", "b"), "b", "left").select(
        "a", "b", "linked", "extra", F.coalesce("component", "b").alias("class"), (F.col("n_b") - F.col("common")).alias("e"), (F.col("n_a") - F.col("common")).alias("m"), F.col("n_b").alias("n")
    )
    near = stored(near, "near")
    share = (1 - similarity) / (1 + similarity)
    named = lambda df, tag, *more: df.select("a", *more, *(F.col(c).alias(f"{c}_{tag}") for c in ("b", "class", "e", "m", "n")))
    other = F.col("class_x") != F.col("class_y")
    least = F.col("e_x") + F.col("e_y") + F.abs(F.col("m_x") - F.col("m_y"))
    room = (F.col("n_x") + F.col("n_y")) * share + 1e-6
    # By e and m alone: with either sign of the difference of m the bound is a term of x plus a term of y, of which
    # the least that any text offers rules out most texts at once.
    terms = near.withColumn("big", F.col("e") + F.col("m") - F.col("n") * share).withColumn("small", F.col("e") - F.col("m") - F.col("n") * share)
    bounds = terms.groupBy("a").agg(*(F.min(F.when(side, F.col(c))).alias(f"{c}_{k}") for k, side in (("odd", ~F.col("linked")), ("all", F.lit(True))) for c in ("big", "small")))
    against = lambda k: F.greatest(F.col("big") + F.col(f"small_{k}"), F.col("small") + F.col(f"big_{k}")) <= 1e-6
    bounded = terms.join(bounds, "a")
    plain = named(bounded.where(against("odd")), "x").join(named(bounded.where(~F.col("linked") & against("all")), "y"), "a").where(other & (least <= room)).select("b_x", "b_y")
    # By shared additional k-mers: those that the very same texts share count as one with a weight.
    rows = near.select("a", "b", "linked", F.explode("extra").alias("kmer"))
    groups = rows.groupBy("a", "kmer").agg(F.count("*").alias("texts"), F.count_if(~F.col("linked")).alias("odd"), F.sum(F.xxhash64("b").cast("decimal(38,0)")).alias("same"))
    groups = groups.where("texts > 1 AND odd > 0").select("a", "kmer", "same")
    weighed = stored(rows.join(groups, ["a", "kmer"]).groupBy("a", "same", "b").agg(F.count("*").alias("weight")), "weighed")
    shareable = weighed.groupBy("a", "b").agg(F.sum("weight").alias("h"))
    weighed = weighed.join(near.drop("extra").join(shareable, ["a", "b"]), ["a", "b"])
    named_h = lambda tag: named(weighed, tag, "same", "weight", "linked", F.col("h").alias(f"h_{tag}"))
    # s is at most what either shares with any text; a pair of two odd texts is taken once.
    can = other & (F.col("linked") | (F.col("b_x") < F.col("b_y"))) & (least - 2 * F.least("h_x", "h_y") <= room)
    both = named_h("x").join(named_h("y").where("NOT linked").drop("linked", "weight"), ["a", "same"]).where(can)
    shared = both.groupBy("a", "b_x", "b_y", "e_x", "e_y", "m_x", "m_y", "n_x", "n_y").agg(F.sum("weight").alias("s")).where(least - 2 * F.col("s") <= room).select("b_x", "b_y")
    return plain.unionByName(shared).select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b")).distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) for every row.

    Where ids repeat, the rows are written with a number each, and the classes are those of the numbered rows: texts of
    one id are documents of their own.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if named.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _classes(docs, doc_id, text, similarity)
    rows = stored(named.withColumn("row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "rows")
    found = _classes(rows.where("row IS NOT NULL"), "row", "text", similarity).withColumnsRenamed({"doc_id": "row", "class_id": "class"})
    placed = stored(found.join(rows.where("row IS NOT NULL").select("row", "doc_id"), "row"), "placed")
    least = placed.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    alone = rows.where("row IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return placed.join(least, "class").select("doc_id", "class_id").unionByName(alone)


def _classes(docs: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """The same for distinct ids."""
    task_session(docs.sparkSession)
    sketched = stored(sketch(docs, doc_id, text), "sketches")
    known = sketched.where("doc_id IS NOT NULL AND key_a IS NOT NULL")
    copies = known.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("rep"))
    # The smallest id of each text stands for its copies.
    reps = known.where("n > 0").join(copies.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def align(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        # By shuffle at any size: the ids grow with the corpus, and one plan is to be the same at every size.
        own = stored(bodies.join(needed.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "bodies")
        return stored(_align(pairs, own, similarity), "aligned")

    aligned = align(_bucket_pairs(reps))
    links = aligned.where("linked").select("a", "b")
    further = _further_pairs(aligned, similarity)
    if further is not None:
        links = links.unionByName(align(further).where("linked").select("a", "b"))
    label = components(links)
    placed = copies.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("key_a", "key_b", F.coalesce("component", "rep").alias("class_id"))
    out = known.select("doc_id", "key_a", "key_b").join(placed, ["key_a", "key_b"]).select("doc_id", "class_id")
    alone = sketched.where("doc_id IS NULL OR key_a IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return out.unionByName(alone)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the class of near copies of every document; ``kept`` marks the one document that stays of each."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))
