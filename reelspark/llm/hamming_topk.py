"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code has a bit for each of its numbers: whether it is above 0. The code is cut into segments, and the
distinct codes are indexed by the value of each segment. A query looks up the values within a radius of its own, segment
by segment. A code that none of the segments has met differs in segment s by more than its radius, so by more than the
sum of (radius + 1) less one altogether: all codes up to that distance have been met. Radii grow, first of all segments
alike, then of a few at a time, until the distance of the query's k-th verified neighbour is covered so. At every table
size all rows of the result come from the index: where a segment has fewer stored values than a radius has flips, its
list of values is walked instead, and the largest radius meets every code.

What a look-up meets is verified in the join: only codes no farther than the query's k-th neighbour so far leave it.
Equal codes are one entry that stands for its rows. Of a code only the k smallest ids can be among the results, so no
more are kept; Spark cuts each group to k before the shuffle, and a code that a third of all rows share is no one
task's work. Buckets are joined by (segment, value), a plain join that Spark can split.

Defined cases: the longest vector of the table decides the length of a code, as in ``OP1_SQL``; null, empty or shorter
vectors and null ids are not searched and do not search; a null or NaN number in a
vector counts as not above 0; ties are resolved by the smaller id; a query finds itself, like any row of distance 0;
repeated rows (of one id and code) are one; with fewer than k rows all of them are returned.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.llm.store import stored

K = 10
#: Bits of a code that are kept in one number at most.
WORD = 64


def _words(bits: int) -> list[tuple[int, int]]:
    """(first bit, size) of the numbers of a code, about equally long."""
    count = math.ceil(bits / WORD)
    cuts = [round(k * bits / count) for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def binary_code(vector: str, bits: int) -> Column:
    """The signs of a vector's numbers as an array of numbers of ``WORD`` bits at most."""

    def word(first: int, size: int) -> Column:
        part = F.slice(F.col(vector), first + 1, size)
        return F.aggregate(part, F.lit(0).cast("long"), lambda code, x: F.shiftleft(code, 1).bitwiseOR(F.when(F.isnan(x), 0).when(x > 0, 1).otherwise(0).cast("long")))

    return F.array(*(word(*w) for w in _words(bits)))


def distance(a: Column, b: Column, words: int) -> Column:
    """Hamming distance of two codes."""
    out = F.lit(0)
    for k in range(words):
        out = out + F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return out


def _segments(bits: int, count: int) -> list[tuple[int, int, int]]:
    """(word, shift, size) of about equally long segments that don't cross a word's end."""
    out = []
    for word, (_, size) in enumerate(_words(bits)):
        own = max(1, round(count * size / bits), math.ceil(size / 31))
        cuts = [round(k * size / own) for k in range(own + 1)]
        out += [(word, size - b, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def _masks(size: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(range(size), radius)]


def search(rows: DataFrame, queries: DataFrame, row_id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank (from 1), neighbour_id, distance: the k nearest rows of each query, ties by the smaller id."""
    first = rows.where(F.size(vector) > 0).agg(F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("most")).first()
    bits = first["most"] or 1
    words = len(_words(bits))

    def coded(df: DataFrame, name: str) -> DataFrame:
        own = df.where(F.col(row_id).isNotNull() & (F.size(vector) == bits))
        return own.select(F.col(row_id).cast("long").alias(name), binary_code(vector, bits).alias("code")).distinct()

    by_id = Window.partitionBy("code").orderBy("id")
    kept = coded(rows, "id").withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k)
    codes = stored(kept.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")
    asked = stored(coded(queries, "query_id"), "asked")
    number = codes.count()
    if number == 0 or asked.isEmpty():
        return asked.select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("neighbour_id"), F.lit(0).alias("distance")).where("false")
    # A segment of log2(n) bits or more has one code in a bucket on average, or fewer.
    parts = _segments(bits, max(1, int(bits / max(1.0, math.log2(number)))))
    value = lambda code, word, shift, size: F.shiftrightunsigned(F.get(code, F.lit(word)), shift).bitwiseAND(F.lit((1 << size) - 1))
    index = stored(codes.select("code", "ids", F.posexplode(F.array(*(value(F.col("code"), *p) for p in parts)))).withColumnRenamed("pos", "segment").withColumnRenamed("col", "value"), "index")
    values = dict(map(tuple, index.groupBy("segment").agg(F.countDistinct("value")).collect()))

    def probes(segment: int, radius: int) -> Column:
        """The stored values that a query looks up, at just this radius."""
        own, size = value(F.col("query"), *parts[segment]), parts[segment][2]
        if radius > size:
            return F.array().cast("array<bigint>")
        if math.comb(size, radius) <= values[segment]:
            return F.transform(_numbers(_masks(size, radius)), lambda m: own.bitwiseXOR(m))
        held = [r[0] for r in index.where(F.col("segment") == segment).select("value").distinct().collect()]
        return F.filter(_numbers(held), lambda v: F.bit_count(own.bitwiseXOR(v)) == radius)

    pair = "struct<distance:int,id:bigint>"
    state = stored(asked.select(F.col("code").alias("query")).distinct().select("query", F.array().cast(f"array<{pair}>").alias("best"), F.lit(None).cast("int").alias("far")), "state")
    radii, done = [-1] * len(parts), []
    largest = max(size for _, _, size in parts)
    nearest = Window.partitionBy("query").orderBy("distance", "id")
    while True:
        # Two radii of all segments, then a quarter of the segments at a time.
        grown = sorted(range(len(parts)), key=lambda s: radii[s])[: len(parts) if min(radii) < 1 else max(1, len(parts) // 4)]
        near = F.array(*(F.struct(F.lit(s).alias("segment"), probes(s, radii[s] + 1).alias("values")) for s in grown))
        probe = state.select("query", "far", F.explode(near).alias("p")).select("query", "far", F.col("p.segment").alias("segment"), F.explode("p.values").alias("value"))
        # The optimiser doesn't see how much explode() adds, so it would take the probes for small and broadcast them.
        probe = probe.hint("merge").alias("probe")
        apart = distance(F.col("query"), F.col("code"), words)
        close = (F.col("probe.segment") == F.col("index.segment")) & (F.col("probe.value") == F.col("index.value")) & (apart <= F.coalesce("far", F.lit(bits)))
        met = index.alias("index").join(probe, close).select("query", apart.cast("int").alias("distance"), F.explode("ids").alias("id"))
        # A row that several segments meet has one rank.
        few = met.withColumn("place", F.dense_rank().over(nearest)).where(F.col("place") <= k)
        found = few.groupBy("query").agg(F.collect_set(F.struct("distance", "id")).alias("found"))
        for s in grown:
            radii[s] += 1
        covered = sum(r + 1 for r in radii) - 1
        best = F.slice(F.array_sort(F.array_distinct(F.concat("best", F.coalesce("found", F.array().cast(f"array<{pair}>"))))), 1, k)
        after = state.join(found, "query", "left").select("query", best.alias("best")).withColumn("far", F.get("best", F.lit(k - 1))["distance"])
        after = stored(after.withColumn("settled", F.lit(min(radii) >= largest) | F.coalesce(F.col("far") <= covered, F.lit(False))), "state")
        done.append(after.where("settled").select("query", F.posexplode("best").alias("place", "near")).select("query", (F.col("place") + 1).alias("rank"), "near.distance", "near.id"))
        state = after.where("NOT settled").drop("settled")
        if state.isEmpty():
            break
    found = done[0]
    for one in done[1:]:
        found = found.unionByName(one)
    out = asked.join(found.withColumnRenamed("query", "code"), "code")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("neighbour_id"), F.col("distance").cast("int").alias("distance"))


def _numbers(values: list[int]) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def op1_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the ten nearest codes of every row whose id is divisible by 100, among all rows of ``embeddings``."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))


OP1_SQL = f"""
WITH c AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: coalesce(x > 0 AND NOT isnan(x), false)) code FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = (SELECT max(len(embedding)) FROM embeddings)),
pairs AS (
  SELECT q.vec_id query_id, c.vec_id neighbour_id,
    CAST(list_sum(list_transform(list_zip(q.code, c.code), lambda p: CAST(p[1] <> p[2] AS INTEGER))) AS INTEGER) distance
  FROM c q, c WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) rank, neighbour_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) rank FROM pairs) WHERE rank <= {K}
"""
