"""End-to-end jobs: normalize, block, score, match, evaluate, train and apply. Stages hand over by Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvine.functions.text import normalize_frame
from corvine.operators import decision, metrics, model, pairs, retrieval, tfidf
from corvine.sources import tables
from corvine.sources.stages import stage

SPLITS, SOURCES = ("train", "test"), (1, 2, 3)


@dataclass(frozen=True)
class Config:
    limits: retrieval.Limits = retrieval.Limits()
    fit_rows: int = 500_000
    threshold: float = 0.5
    thresholds: tuple[float, ...] = (0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70)
    floor: float = 0.15


def normalize(spark: SparkSession, source: str, target: str, force: bool = False) -> None:
    """Six TSV files ({split}_source{n}.tsv) to normalized Parquet with their order."""
    for split in SPLITS:
        for n in SOURCES:
            rows = tables.with_order(tables.read_tsv(spark, f"{source}/{split}_source{n}.tsv"), n)
            tables.write_parquet(normalize_frame(rows), f"{target}/{split}_source{n}.parquet", force)


def block(s1: DataFrame, pool: DataFrame, tsv: str, parquet: str, config: Config | None = None, force: bool = False) -> int:
    """Candidates as id pairs (Parquet) and as a compact table (TSV) from the same rows; returns the number of pairs."""
    config = config or Config()
    found = retrieval.retrieve(s1, pool, config.limits)
    tables.write_parquet(found, parquet, force)
    found = s1.sparkSession.read.parquet(parquet)
    tables.write_tsv(retrieval.compact(s1, found), tsv, force)
    return found.count()


def vocabularies(sources: list[DataFrame], fit_rows: int) -> tuple[DataFrame, DataFrame]:
    """Name and address vocabularies over the first rows of each source."""
    heads = [tables.head(s.select("ord", "normalized_name", "normalized_address"), fit_rows // 3) for s in sources]
    rows = heads[0]
    for h in heads[1:]:
        rows = rows.unionByName(h)
    return tfidf.fit(rows, "normalized_name"), tfidf.fit(rows, "normalized_address")


def score(found: DataFrame, s1: DataFrame, pool: DataFrame, names: DataFrame, addresses: DataFrame) -> DataFrame:
    return pairs.features(stage(pairs.for_scoring(found.select("source1_entity_id", "candidate_id"), s1, pool)), names, addresses)


def score_to(found: DataFrame, s1: DataFrame, pool: DataFrame, vocabulary: str, target: str, buckets: int = 35, only: int | None = None) -> list[int]:
    """Score into resumable buckets by a saved vocabulary; buckets that are finished are left out before anything is scored."""
    spark = s1.sparkSession
    names, addresses = (tfidf.load_vocabulary(spark, vocabulary, field) for field in ("name", "address"))
    return tables.write_in_buckets(score(found, s1, pool, names, addresses), target, "source1_entity_id", buckets, only)


def match(scored: DataFrame, s1: DataFrame, tsv: str, threshold: float, force: bool = False) -> None:
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    tables.write_tsv(decision.match(scored, spine, threshold), tsv, force)


def holdout(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, n_s1: int, n_distractors: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first n_s1 records, their truth, and a pool of their true matches and the first distractors of either source."""
    some = tables.head(s1, n_s1)
    known = truth.join(some.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    every = s2.unionByName(s3)
    true = every.join(known.select(F.col("matched_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    others = tables.head(s2, n_distractors // 2).unionByName(tables.head(s3, n_distractors // 2)).join(true.select("entity_id"), "entity_id", "left_anti")
    # Of records that share an id the first by source and order stays.
    rows = true.unionByName(others)
    first = rows.groupBy("entity_id").agg(F.min(F.struct("src", "ord")).alias("_k")).select("entity_id", "_k.src", "_k.ord")
    return some, rows.join(first, ["entity_id", "src", "ord"], "left_semi").dropDuplicates(["entity_id"]), known


def evaluate(s1: DataFrame, pool: DataFrame, truth: DataFrame, config: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """Blocking recall by country and sizes of candidate lists."""
    found = retrieval.retrieve(s1, pool, (config or Config()).limits)
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return metrics.blocking_recall(truth, found, s1), metrics.size_stats(spine, found)


def tune(scored: DataFrame, s1: DataFrame, truth: DataFrame, config: Config | None = None, score: str = "combined_score", by_country: bool = False) -> DataFrame:
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"), "country")
    return metrics.threshold_sweep(spine, truth, scored, list((config or Config()).thresholds), score, "country" if by_country else None)


def train(scored: DataFrame, s1: DataFrame, truth: DataFrame, path: str, thresholds: tuple[float, ...] = tuple(i / 20 for i in range(6, 19))) -> float:
    """Train on one part of the records, choose the threshold on the other, save both; returns the threshold."""
    learn, rest = model.split_records(stage(metrics.labelled(scored, truth)))
    fitted = model.train(learn)
    probed = model.predict(fitted, rest)
    spine = s1.select(F.col("entity_id").alias("source1_entity_id")).join(rest.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    best = metrics.best_threshold(metrics.threshold_sweep(spine, truth, probed, list(thresholds), "proba")).first()
    model.save(fitted, path, model.FEATURES, best["threshold"])
    return best["threshold"]


def apply(scored: DataFrame, s1: DataFrame, path: str, tsv: str, cache: str | None = None, config: Config | None = None, force: bool = False) -> None:
    """Predict, decide, write; with ``cache``, the probabilities above the floor too."""
    fitted, _, threshold = model.load(path)
    proba = stage(model.predict(fitted, scored))
    if cache:
        tables.write_parquet(decision.probability_cache(proba, (config or Config()).floor), cache, force)
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    tables.write_tsv(decision.group_matches(decision.accepted_pairs(proba, threshold, "proba"), spine), tsv, force)


def variants(cache: DataFrame, s1: DataFrame, train_s1: DataFrame | None, specs: list[str], target: str, force: bool = False) -> list[str]:
    """Results for each 'cutoff[:cutoff for unseen countries]' from one probability cache."""
    unseen = decision.unseen_countries(s1, train_s1)
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    names = []
    for spec in specs:
        general, _, strict = spec.partition(":")
        g, f = float(general), float(strict or general)
        names.append(f"matching_results_{decision.variant_name(g, f)}")
        tables.write_tsv(decision.group_matches(decision.variant_pairs(cache, s1, unseen, g, f), spine), f"{target}/{names[-1]}", force)
    return names


def smoke(found: DataFrame, s1: DataFrame, pool: DataFrame, config: Config | None = None, fit_rows: int = 30_000) -> dict:
    """A quick look: fit on a few records, score, and report counts, quantiles, what each threshold accepts, and the ten best pairs."""
    config = config or Config()
    every = [s1, *(pool.where(F.col("src") == n) for n in SOURCES[1:])]
    joined = stage(pairs.for_scoring(found.select("source1_entity_id", "candidate_id"), s1, pool))
    scored = stage(pairs.features(joined, *vocabularies(every, fit_rows)))
    missing = joined.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("s1_norm_name") == "").alias("s1_names_missing"), F.count_if(F.col("cand_norm_name") == "").alias("cand_names_missing")).first()
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"))
    preview = {t: decision.summary(decision.group_matches(accepted, spine), accepted).first().asDict() for t in config.thresholds for accepted in [stage(decision.accepted_pairs(scored, t))]}
    best = scored.orderBy(F.desc("combined_score"), "source1_entity_id", "candidate_id").limit(10)
    return missing.asDict() | {"quantiles": metrics.score_quantiles(scored).first().asDict(), "preview": preview, "best": [r.asDict() for r in best.collect()]}
