"""Registered queries of the record-linkage operators, over views of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvine.functions.keys import address_keys, name_keys
from corvine.functions.text import expand_suffixes, normalize_frame
from corvine.operators import decision, metrics, model, pairs, retrieval, tfidf
from corvine.plans import validate, views
from corvine.sources.stages import stage

LIMITS = retrieval.Limits(cap=150, max_block=1000, sample=20)
#: Small limits, for the queries that show what the guards do.
GUARDED = retrieval.Limits(cap=30, max_block=40, sample=10)
THRESHOLD = 0.5
THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]
CUTOFF, UNSEEN_CUTOFF = 0.35, 0.65


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stage(normalize_frame(rows))
    return rows.where("src = 1"), rows.where("src > 1")


def _spine(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("source1_entity_id"), "country")


def _scored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s1, pool = _sides(views.parts(spark, d))
    found = retrieval.retrieve(s1, pool, LIMITS).select("source1_entity_id", "candidate_id")
    every = s1.unionByName(pool)
    joined = stage(pairs.for_scoring(found, s1, pool))
    return pairs.features(joined, tfidf.fit(every, "normalized_name"), tfidf.fit(every, "normalized_address")), s1, pool


def normalize_text(spark, d):
    return normalize_frame(views.parts(spark, d).unionByName(views.docs(spark, d))).select("entity_id", "src", "ord", "normalized_name", "normalized_address")


def suffix_expand(spark, d):
    words = F.lower(F.regexp_replace("business_name", "[.&]", ""))
    return views.parts(spark, d).select("entity_id", expand_suffixes(words).alias("expanded"))


def _keys(rows: DataFrame, keys) -> DataFrame:
    return rows.select("entity_id", F.posexplode(keys).alias("i", "block_key")).select("entity_id", "block_key", (F.row_number().over(_by_record()) - 1).alias("i"))


def _by_record():
    from pyspark.sql.window import Window

    return Window.partitionBy("entity_id").orderBy("i")


def name_key_list(spark, d):
    rows = normalize_frame(views.parts(spark, d))
    return _keys(rows, name_keys(F.col("normalized_name")))


def address_key_list(spark, d):
    rows = normalize_frame(views.docs(spark, d))
    return _keys(rows, address_keys(F.col("normalized_address")))


def record_keys(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return retrieval.record_keys(s1.unionByName(pool)).select("entity_id", "country", "block_key", "pos")


def block_stats(spark, d):
    return retrieval.block_stats(retrieval.record_keys(_sides(views.parts(spark, d))[1]))


def block_oversize(spark, d):
    return block_stats(spark, d).where(F.col("n") > GUARDED.max_block)


def candidates_tiered_cap(spark, d):
    return retrieval.retrieve(*_sides(views.parts(spark, d)), LIMITS)


def candidates_guarded(spark, d):
    return retrieval.retrieve(*_sides(views.parts(spark, d)), GUARDED)


def candidates_compact(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return retrieval.compact(s1, stage(retrieval.retrieve(s1, pool, LIMITS)))


def pair_explode(spark, d):
    return retrieval.id_pairs(candidates_compact(spark, d))


def pair_metadata_join(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return pairs.with_metadata(retrieval.retrieve(s1, pool, LIMITS), s1, pool, include_normalized=True)


def tfidf_vocab(spark, d):
    rows = tfidf.fit(normalize_frame(views.docs(spark, d)), "normalized_name")
    return rows.select("term", "df", "total", F.bround("idf", 6).alias("idf"))


def tfidf_pair_cosine(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    found = stage(pairs.for_scoring(retrieval.retrieve(s1, pool, LIMITS), s1, pool))
    like = tfidf.pair_cosine(found, "s1_norm_name", "cand_norm_name", stage(tfidf.fit(s1.unionByName(pool), "normalized_name")))
    return like.select("s1_norm_name", "cand_norm_name", F.bround("similarity", 4).alias("similarity"))


def pair_features(spark, d):
    return _scored(spark, d)[0]


def accept_group(spark, d):
    scored, s1, _ = _scored(spark, d)
    return decision.match(scored, _spine(s1).select("source1_entity_id"), THRESHOLD)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.bround(c, 6) for c in columns})


def macro_f05(spark, d):
    scored, s1, _ = _scored(spark, d)
    return _rounded(metrics.macro_f(_spine(s1), views.part_truth(spark, d), decision.accepted_pairs(scored, THRESHOLD)), "f", "precision", "recall")


def macro_f05_by_country(spark, d):
    scored, s1, _ = _scored(spark, d)
    return _rounded(metrics.macro_f(_spine(s1), views.part_truth(spark, d), decision.accepted_pairs(scored, THRESHOLD), "country"), "f", "precision", "recall")


def threshold_sweep(spark, d):
    scored, s1, _ = _scored(spark, d)
    return _rounded(metrics.threshold_sweep(_spine(s1), views.part_truth(spark, d), scored, THRESHOLDS), "f", "precision", "recall")


def threshold_argmax(spark, d):
    return metrics.best_threshold(threshold_sweep(spark, d)).select("threshold", "f")


def blocking_recall_rollup(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return _rounded(metrics.blocking_recall(views.part_truth(spark, d), retrieval.retrieve(s1, pool, LIMITS), s1), "recall")


def candidate_size_stats(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return _rounded(metrics.size_stats(_spine(s1).select("source1_entity_id"), retrieval.retrieve(s1, pool, LIMITS)), "mean")


def score_quantiles(spark, d):
    return _rounded(metrics.score_quantiles(stage(_scored(spark, d)[0])), "mean")


def top10_scores(spark, d):
    return _scored(spark, d)[0].select("source1_entity_id", "candidate_id", "combined_score").orderBy(F.desc("combined_score"), "source1_entity_id", "candidate_id").limit(10)


def embedding_cosine(spark, d):
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    vectors = rows.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"), "embedding")
    asked = rows.select("vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("a"), F.when(F.col("vec_id") % 7 == 0, "").otherwise(F.concat(F.lit("v"), (F.col("vec_id") + 1).cast("string"))).alias("b"))
    return pairs.embedding_similarity(asked, "a", "b", vectors).select("vec_id", "emb_name_similarity")


def length_features(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    found = retrieval.retrieve(s1, pool, LIMITS)
    return _rounded(pairs.length_features(pairs.for_scoring(found, s1, pool)), "name_len_ratio")


def _train_countries(s1: DataFrame) -> DataFrame:
    return s1.where("country in ('US', 'France')")


def unseen_countries(spark, d):
    s1 = views.docs(spark, d).where("src = 1")
    return decision.unseen_countries(s1, s1.where("country in ('en', 'fr')"))


def variant_cutoffs(spark, d):
    scored, s1, _ = _scored(spark, d)
    cache = decision.probability_cache(scored.withColumn("proba", F.col("combined_score")))
    chosen = decision.variant_pairs(cache, s1, decision.unseen_countries(s1, _train_countries(s1)), CUTOFF, UNSEEN_CUTOFF)
    return decision.group_matches(chosen, _spine(s1).select("source1_entity_id"))


def validate_output(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    found = stage(retrieval.retrieve(s1, pool, LIMITS))
    results = retrieval.compact(s1, found).withColumnRenamed("candidate_entity_ids", "matched_entity_ids")
    # Spoilt on purpose, so that rules have something to find.
    number = F.substring("source1_entity_id", 4, 20).cast("long")
    spoilt = F.when(number % 11 == 0, F.lit("S2-1,S2-1")).when(number % 13 == 0, F.lit("S1-3")).otherwise(F.col("matched_entity_ids"))
    return validate.violations(results.where(number % 17 != 0).withColumn("matched_entity_ids", spoilt), s1, pool, found)


def label_pairs(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return metrics.labelled(retrieval.retrieve(s1, pool, LIMITS).select("source1_entity_id", "candidate_id"), views.part_truth(spark, d))


def truth_semi_join(spark, d):
    some = views.docs(spark, d).where("src = 1").orderBy("ord").limit(100)
    return views.truth(spark, d).join(some.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")


def unique_names(spark, d):
    s1, pool = _sides(views.parts(spark, d))
    return pairs.unique_names(s1, pool)


def decision_summary(spark, d):
    scored, s1, _ = _scored(spark, d)
    accepted = stage(decision.accepted_pairs(scored, THRESHOLD))
    return _rounded(decision.summary(decision.group_matches(accepted, _spine(s1).select("source1_entity_id")), accepted), "pairs_each")


def gbt_scores(spark, d):
    scored, _, _ = _scored(spark, d)
    rows = stage(metrics.labelled(scored, views.part_truth(spark, d)))
    learn, _ = model.split_records(rows)
    return model.predict(model.train(learn, rounds=5, depth=3), rows)


QUERIES = {
    f.__name__: f
    for f in (
        normalize_text, suffix_expand, name_key_list, address_key_list, record_keys, block_stats, block_oversize, candidates_tiered_cap, candidates_guarded,
        candidates_compact, pair_explode, pair_metadata_join, tfidf_vocab, tfidf_pair_cosine, pair_features, accept_group, macro_f05,
        macro_f05_by_country, threshold_sweep, threshold_argmax, blocking_recall_rollup, candidate_size_stats, score_quantiles, top10_scores,
        embedding_cosine, length_features, unseen_countries, variant_cutoffs, validate_output, label_pairs, truth_semi_join, unique_names,
        decision_summary, gbt_scores,
    )
}
