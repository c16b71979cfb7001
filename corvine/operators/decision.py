"""From scored pairs to matches: thresholds, grouping, variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prefixes of ids that may be matched.
POOL_PREFIXES = ("S2-", "S3-")


def is_pool_id(column: str = "candidate_id") -> Column:
    out = F.lit(False)
    for p in POOL_PREFIXES:
        out = out | F.startswith(F.col(column), F.lit(p))
    return out


def accepted_pairs(scored: DataFrame, threshold: float, score: str = "combined_score") -> DataFrame:
    """Distinct pairs strictly above the threshold whose candidate is a pool record."""
    rows = scored.where(F.col(score) > threshold).where(is_pool_id())
    return rows.select("source1_entity_id", "candidate_id").distinct()


def group_matches(accepted: DataFrame, spine: DataFrame) -> DataFrame:
    """One row for each id of ``spine`` (source1_entity_id): its distinct matches, sorted, as a comma string, '' if none."""
    lists = accepted.groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("candidate_id")), ",").alias("ids"))
    return spine.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def match(scored: DataFrame, spine: DataFrame, threshold: float) -> DataFrame:
    return group_matches(accepted_pairs(scored, threshold), spine)


def unseen_countries(test: DataFrame, train: DataFrame | None) -> DataFrame:
    """Distinct countries of test that train lacks (all of them without train); nulls are left out."""
    own = test.where("country is not null").select("country").distinct()
    return own if train is None else own.join(train.select("country"), "country", "left_anti")


def variant_pairs(cache: DataFrame, s1: DataFrame, unseen: DataFrame, cutoff: float, unseen_cutoff: float) -> DataFrame:
    """Pairs above the cutoff of their record's class of country; a record without a country gives none."""
    rows = cache.join(s1.select(F.col("entity_id").alias("source1_entity_id"), "country"), "source1_entity_id", "left").where("country is not null")
    strict = unseen.select("country", F.lit(True).alias("strict"))
    least = F.when(F.coalesce("strict", F.lit(False)), F.lit(unseen_cutoff)).otherwise(F.lit(cutoff))
    return rows.join(strict, "country", "left").where(F.col("proba") > least).select("source1_entity_id", "candidate_id")


def variant_name(cutoff: float, unseen_cutoff: float) -> str:
    return f"thr{cutoff}_unseen{unseen_cutoff}".replace(".", "p")


def probability_cache(scored: DataFrame, floor: float = 0.15) -> DataFrame:
    return scored.where(F.col("proba") > floor).select("source1_entity_id", "candidate_id", F.bround("proba", 4).alias("proba"))


def summary(matches: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: accepted pairs, records with a match, pairs a record."""
    n = matches.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("matched_entity_ids") != "").alias("n_matched"))
    pairs = accepted.agg(F.count(F.lit(1)).alias("n_pairs"))
    return n.crossJoin(F.broadcast(pairs)).select("n_pairs", "n_matched", (F.col("n_pairs") / F.col("n")).alias("pairs_each"))  # two single rows
