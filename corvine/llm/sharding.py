"""Sharding: a keyed Feistel permutation with cycle walking over global row numbers; DataFrame functions only.

Method. Rows are numbered 0 to N-1 by doc_id (ties by size and CRC of the text). The numbers live in a grid of a x b cells,
a = ceil(sqrt N), b = ceil(N / a); a Feistel network of alternating additions modulo a and modulo b permutes the grid, and a
result of N or more is permuted again until it is below N (cycle walking), which makes it a permutation of 0 to N-1. With p
the permuted number, the shard is p mod shards and the slot p div shards: counts differ by one at most (law ``rows``), slots
are gapless, and both can be computed from the row number alone.

Global numbers: rows are dealt by range, numbered within partitions, and the partitions' offsets are added by broadcast, one row
a partition; equal rows, however many, are spread. Only ids, sizes and CRCs are shuffled, never texts.

Defined cases. A null text has size 1 and CRC 0. A null doc_id sorts first. Repeated rows each get a place of their own;
equal in all order columns, they are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import numbered

SHARDS, SEED, ROUNDS, WALKS = 16, 20240229, 6, 64


def grid(n: int) -> tuple[int, int]:
    """The sides of the smallest near-square grid with at least n cells."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _permuted(x: Column, a: int, b: int, seed: int, rounds: int) -> Column:
    """One pass of the network over x in 0 to a*b - 1, as a struct chain so that each half is computed once a round."""
    pair = F.struct((x % F.lit(a)).alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))

    def step(s: Column, k: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], k, F.lit(seed)), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(left, k, F.lit(~seed)), F.lit(b)), F.lit(b))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    return F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), pair, step, lambda s: s["r"] * F.lit(a) + s["l"])


def permuted(row: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> tuple[Column, Column]:
    """Of row number ``row`` among n rows the first place, and the place after walking, an expression of a column ``_place`` with the first."""
    a, b = grid(n)
    once = lambda x: _permuted(x, a, b, seed, rounds)
    first = once(row.cast("long"))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.col("_place"), lambda x, _: F.when(x >= F.lit(n), once(x)).otherwise(x))
    return first, F.when(F.col("_place") < F.lit(n), F.col("_place")).otherwise(walked)


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows = numbered(rows, ["doc_id", "size", "text_crc32"]).withColumnRenamed("number", "row_number")
    n = docs.count()
    first, place = permuted(F.col("row_number"), n, seed)
    rows = rows.withColumn("_place", first).withColumn("_place", place)
    # Compared in the row, so that an unfinished walk fails the job.
    sound = F.when(F.col("_place") < F.lit(n), F.col("_place")).otherwise(F.raise_error(F.lit("cycle walk unfinished")).cast("long"))
    rows = rows.withColumn("_place", sound)
    return rows.select("doc_id", "size", "text_crc32", "row_number", F.pmod(F.col("_place"), F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("_place") / F.lit(shards)).cast("long").alias("slot"))
