"""Connected components of an edge table by alternating large-star and small-star steps.

Nodes and edges stay distributed; each round ends in a reliable checkpoint, and only a count and two sums of hashes reach the
driver. The smallest node of a component is its root. Edges are never expanded to all pairs of a component.

A caller may say up to how many edges one task is to unite them (``few``), as rounds over a few edges cost more than the edges do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import durable, forget


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two sums of 64-bit hashes, exact."""
    sums = [F.sum(F.xxhash64("a", "b", F.lit(seed)).cast("decimal(20,0)")).alias(f"s{seed}") for seed in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)).alias("n"), *sums).first())


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(np.fromiter(map(find, nodes), np.int64, len(nodes)))], ["node", "root"])


def connected_components(edges: DataFrame, few: int = 0) -> DataFrame:
    """(node, root) for every node of edges (a long, b long) that isn't itself a root. ``edges`` is read twice where few is given."""
    if few and edges.count() <= few:
        return durable(edges.select("a", "b").coalesce(1).mapInArrow(_united, "node long, root long"))
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        before, now = now, durable(_small_star(_large_star(now)))
        forget(before)
        was, state = state, _state(now)
        if was == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def named(nodes: DataFrame, edges: DataFrame, few: int = 0) -> DataFrame:
    """(node, gid, component_id) for nodes (node long, least: its smallest doc_id): gid is the component's smallest node,
    component_id the smallest ``least`` in it."""
    members = durable(nodes.join(connected_components(edges, few), "node", "left").select("node", "least", F.coalesce("root", "node").alias("gid")))
    least = members.groupBy("gid").agg(F.min("least").alias("component_id"))
    return durable(members.join(least, "gid").select("node", "gid", "component_id"))
