"""Candidate retrieval: an inverted index of blocking keys, an equi-join on (country, key), and a priority top-k for each record.

Everything stays in id-only rows; texts are joined late. The rules: a record's keys are in order of tier, then generation. A block
counts if it has ``max_block`` records or fewer; one that is larger counts only if it is the record's first block that has any, and
then with its first ``sample`` records. A candidate is placed by the first key that finds it, then by its order in the pool.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corvine.functions.keys import blocking_keys, clean_country, tier
from corvine.functions.text import normalize_frame
from corvine.sources import tables
from corvine.sources.stages import stage


@dataclass(frozen=True)
class Limits:
    cap: int = field(default_factory=lambda: int(os.environ.get("BLOCKING_MAX_CANDIDATES", "150")))
    max_block: int = 1000
    sample: int = 20


def with_normalized(df: DataFrame) -> DataFrame:
    return df if {"normalized_name", "normalized_address"} <= set(df.columns) else normalize_frame(df)


def record_keys(df: DataFrame) -> DataFrame:
    """entity_id, country, block_key, pos (from 0, by tier and generation), and ord where df has it."""
    rest = [c for c in ("src", "ord") if c in df.columns]
    keys = blocking_keys(F.col("normalized_name"), F.col("normalized_address"))
    ranked = F.array_sort(F.transform(keys, lambda k, i: F.struct(tier(k).alias("tier"), i.alias("i"), k.alias("k"))))
    rows = with_normalized(df).select("entity_id", clean_country(F.col("country")).alias("country"), *rest, F.posexplode(ranked).alias("pos", "k"))
    return rows.select("entity_id", "country", F.col("k.k").alias("block_key"), "pos", *rest)


def block_stats(pool_keys: DataFrame) -> DataFrame:
    return pool_keys.groupBy("country", "block_key").agg(F.count(F.lit(1)).alias("n"))


def retrieve(s1: DataFrame, pool: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(source1_entity_id, candidate_id, rank from 1). pool has src and ord, which give its order."""
    limits = limits or Limits()
    # Of each block at most max_block + 1 postings are kept, pruned on the map side, so no block is gathered however large it is; blocks
    # are dealt once, and their sizes, as far as they matter, come from the same partitioning.
    block = Window.partitionBy("country", "block_key")
    right = record_keys(pool).select("country", "block_key", F.col("entity_id").alias("candidate_id"), "src", "ord")
    right = right.withColumn("at", F.row_number().over(block.orderBy("src", "ord"))).where(F.col("at") <= max(limits.max_block + 1, limits.sample))
    postings = stage(right.withColumn("n", F.max("at").over(block)).where((F.col("n") <= limits.max_block) | (F.col("at") <= limits.sample)))
    keys = record_keys(s1).join(postings.where("at = 1").select("country", "block_key", "n"), ["country", "block_key"])
    by_record = Window.partitionBy("entity_id").orderBy("pos")
    # A block behind one that alone fills the cap can add nothing.
    filled = F.max(F.when(F.col("n") <= limits.max_block, F.col("n"))).over(by_record.rowsBetween(Window.unboundedPreceding, -1))
    keys = keys.withColumns({"first": F.min("pos").over(Window.partitionBy("entity_id")), "filled": filled})
    keys = keys.where((F.col("n") <= limits.max_block) | (F.col("pos") == F.col("first"))).where(F.coalesce("filled", F.lit(0)) < limits.cap)
    keys = keys.select(F.col("entity_id").alias("source1_entity_id"), "country", "block_key", "pos")
    # Dealt by record once, for the candidates' places and for the top-k; a record meets at most its keys times max_block postings.
    met = keys.join(postings.select("country", "block_key", "candidate_id", "src", "ord"), ["country", "block_key"]).repartition("source1_entity_id")
    found = met.groupBy("source1_entity_id", "candidate_id").agg(F.min(F.struct("pos", "src", "ord")).alias("place"))
    best = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy("place", "candidate_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= limits.cap).select("source1_entity_id", "candidate_id", "rank")


def compact(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row for each record of s1, its candidates in order as a comma string, '' if it has none."""
    lists = candidates.groupBy("source1_entity_id").agg(F.array_sort(F.collect_list(F.struct("rank", "candidate_id"))).alias("l"))
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    ids = F.array_join(F.transform("l", lambda x: x["candidate_id"]), ",")
    return spine.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(ids, F.lit("")).alias("candidate_entity_ids"))


def id_pairs(compacted: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_id) of a compact table, without empties."""
    rows = compacted.where(F.octet_length("candidate_entity_ids") > 0)
    rows = rows.select("source1_entity_id", F.explode(F.split("candidate_entity_ids", ",")).alias("candidate_id"))
    return rows.where(F.octet_length("candidate_id") > 0)


def with_batches(pairs: DataFrame, size: int = 200_000) -> DataFrame:
    """pairs with ``batch``, numbers of batches of at most ``size`` rows: a record's rows stay together unless they alone pass it.

    Batches are numbered within partitions by source record, ``part`` first, so nothing goes through the driver or a global sort.
    """
    rows = pairs.repartition("source1_entity_id").sortWithinPartitions("source1_entity_id", "candidate_id")
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("batch", T.LongType()), *pairs.schema.fields])
    at = pairs.columns.index("source1_entity_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # rows of the record that the rows so far end in
        batch, filled = 0, 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal batch, filled
            n = sum(x.num_rows for x in held)
            if filled and filled + n > size:
                batch, filled = batch + 1, 0
            for x in held:
                done = 0
                while done < x.num_rows:
                    if filled == size:
                        batch, filled = batch + 1, 0
                    take = min(size - filled, x.num_rows - done)
                    numbers = [pa.array(np.full(take, part, np.int32)), pa.array(np.full(take, batch, np.int64))]
                    yield pa.record_batch([*numbers, *x.slice(done, take).columns], schema.names)
                    done, filled = done + take, filled + take
            held.clear()

        for piece in batches:
            ids = piece.column(at).to_pylist()
            cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and held[-1].column(at)[0].as_py() != ids[a]:
                    yield from closed()
                held.append(piece.slice(a, b - a))
                if sum(x.num_rows for x in held) >= 2 * size:
                    yield from closed()
        yield from closed()

    return rows.mapInArrow(run, schema)


def pair_batches(pairs: DataFrame, size: int = 200_000) -> Iterator[list]:
    """Lists of at most ``size`` rows for a reader on the driver; it holds one partition at a time."""
    rows, own = [], None
    for row in with_batches(pairs, size).toLocalIterator():
        if rows and (row["part"], row["batch"]) != own:
            yield rows
            rows = []
        own = row["part"], row["batch"]
        rows.append(row)
    if rows:
        yield rows


def pairs_from_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, candidate_id) of a candidate table on disk, as ``write_tsv`` of a compact table wrote it."""
    return id_pairs(tables.read_tsv(spark, path, tables.CANDIDATES, blanks=True))
