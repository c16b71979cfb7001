"""Rules for result tables as counts of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.operators.decision import is_pool_id


def violations(results: DataFrame, s1: DataFrame, pool: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rule, kind, n) of a result table: kind 'error' must be 0, 'warning' should be.

    results: source1_entity_id, matched_entity_ids; candidates: source1_entity_id, candidate_id.
    """
    ids = results.where("matched_entity_ids <> ''").select("source1_entity_id", F.split("matched_entity_ids", ",").alias("l"))
    each = ids.select("source1_entity_id", F.explode("l").alias("candidate_id"))
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    rules = {
        ("record_missing", "error"): spine.join(results, "source1_entity_id", "left_anti"),
        ("record_unknown", "error"): results.join(spine, "source1_entity_id", "left_anti"),
        ("record_repeated", "error"): results.groupBy("source1_entity_id").count().where("count > 1"),
        ("id_repeated", "error"): ids.where(F.size(F.array_distinct("l")) < F.size("l")),
        ("id_prefix", "error"): each.where(~is_pool_id()),
        ("id_unknown", "warning"): each.join(pool.select(F.col("entity_id").alias("candidate_id")), "candidate_id", "left_anti"),
        ("not_a_candidate", "warning"): each.join(candidates, ["source1_entity_id", "candidate_id"], "left_anti"),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), "n") for (rule, kind), df in rules.items()]
    return reduce(DataFrame.unionByName, counts)
