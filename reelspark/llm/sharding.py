"""Placing rows on shards with a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in its own order (a start and a step from its name's hash,
which runs through all slots as the size is prime). The shards take turns, each claiming the first slot of its order
that is still free, until the table is full. A row's key is hashed to a slot, and the slot's shard is the row's. The
shards' shares differ by one slot at most, and when a shard comes or goes only about its own share of the slots
changes hands.

The table depends on the shards' names alone. It is filled on the driver, with ``size`` entries (bounded by
``MAX_SLOTS``), and joined by broadcast: placement is one hash and one lookup in DataFrame functions, without a
shuffle, so a hot source or key needs no splitting.

Defined cases: a null key is hashed as such and has one slot, and null and the text "null" differ; equal keys share a
slot; an empty table gives no rows; ``slot`` and ``shard`` replace columns of those names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots: a prime, at least a hundred for each shard, so that shares differ by one in a hundred at most.
SLOTS = 5003
SHARDS = 50
MAX_SLOTS = 1_000_003


def _hash(text: str, first: int) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[first : first + 8], 16)


def fill(shards: list[str], size: int = SLOTS) -> list[int]:
    """For each slot, the number of the shard that holds it."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, at least one and at most one for each slot")
    if size > MAX_SLOTS or size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime of at most {MAX_SLOTS}")
    place = [_hash(name, 0) % size for name in shards]
    step = [_hash(name, 8) % (size - 1) + 1 for name in shards]
    table, claimed = [-1] * size, 0
    while True:
        for k in range(len(shards)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % size
            table[place[k]] = k
            claimed += 1
            if claimed == size:
                return table


def slot_of(*keys: Column, size: int = SLOTS) -> Column:
    """The slot of a key: the first eight hex digits of the MD5 of its parts, modulo the size."""
    parts = [F.when(k.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), k.cast("string"))) for k in keys]
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("\x01", *parts)), 1, 8), 16, 10).cast("long"), F.lit(size))


def lookup_table(spark: SparkSession, shards: list[str], size: int = SLOTS) -> DataFrame:
    """slot, shard: the filled table as a DataFrame of ``size`` rows."""
    filled = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",").cast("array<int>")
    names = F.split(F.lit("\x01".join(shards)), "\x01")
    return spark.range(size).select(F.col("id").alias("slot"), F.get(names, F.get(filled, F.col("id").cast("int"))).alias("shard"))


def place(df: DataFrame, keys: list[str], shards: list[str], size: int = SLOTS) -> DataFrame:
    """Adds ``slot`` (long) and ``shard`` (the shard's name) to every row."""
    df = df.drop(*(c for c in df.columns if c.lower() in {"slot", "shard"}))
    table = F.broadcast(lookup_table(df.sparkSession, shards, size))  # of MAX_SLOTS rows at most
    return df.withColumn("slot", slot_of(*(F.col(k) for k in keys), size=size)).join(table, "slot").select(*df.columns, "slot", "shard")


def shard_names(number: int = SHARDS) -> list[str]:
    return [f"shard-{k:03d}" for k in range(number)]


def op5_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the slot and shard of every document, by its id."""
    return place(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars"), ["doc_id"], shard_names())


OP5_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT CAST(k AS INTEGER) k, 'shard-' || lpad(CAST(k AS VARCHAR), 3, '0') AS shard, CAST('0x' || md5('shard-' || lpad(CAST(k AS VARCHAR), 3, '0'))[1:8] AS BIGINT) % {SLOTS} AS start,
    CAST('0x' || md5('shard-' || lpad(CAST(k AS VARCHAR), 3, '0'))[9:16] AS BIGINT) % {SLOTS - 1} + 1 AS step FROM range({SHARDS}) t(k)),
fill AS (
  SELECT -1 AS turn, CAST(NULL AS BIGINT) AS slot, list_resize(CAST([] AS BOOLEAN[]), {SLOTS}, false) AS taken, (SELECT list(start ORDER BY k) FROM shards) AS place
  UNION ALL
  SELECT turn + 1, s, list_concat(taken[1:s], [true], taken[s + 2:]), list_concat(place[1:k], [s], place[k + 2:])
  FROM (
    SELECT turn, taken, place, k,
      (place[k + 1] + step * list_position(list_transform(range({SLOTS}), lambda j: taken[(place[k + 1] + step * j) % {SLOTS} + 1]), false) - step) % {SLOTS} AS s
    FROM fill JOIN shards ON k = (turn + 1) % {SHARDS} WHERE turn + 1 < {SLOTS})),
placed AS (SELECT slot, shard FROM fill JOIN shards ON k = turn % {SHARDS} WHERE turn >= 0)
SELECT doc_id, source, n_chars, slot, shard FROM (
  SELECT *, CAST('0x' || md5(coalesce('v' || CAST(doc_id AS VARCHAR), 'n'))[1:8] AS BIGINT) % {SLOTS} AS slot FROM documents) JOIN placed USING (slot)
"""
