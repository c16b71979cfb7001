"""Evaluation: macro F-beta for each record, sweeps over thresholds, blocking recall, sizes and quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BETA_SQUARED = 0.25


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_id) of a truth table with comma strings; blanks are dropped, repeats kept."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return truth.select("source1_entity_id", F.explode(ids).alias("matched_id"))


def _scores(counts: DataFrame) -> DataFrame:
    """tp, np, nt -> precision, recall, f."""
    both_empty = (F.col("np") == 0) & (F.col("nt") == 0)
    p = F.when(both_empty, 1.0).when(F.col("np") == 0, 0.0).otherwise(F.col("tp") / F.col("np"))
    r = F.when(both_empty, 1.0).when(F.col("nt") == 0, 0.0).otherwise(F.col("tp") / F.col("nt"))
    out = counts.withColumns({"p": p, "r": r})
    below = F.col("p") * BETA_SQUARED + F.col("r")
    return out.withColumn("f", F.when(below == 0, 0.0).otherwise((1 + BETA_SQUARED) * F.col("p") * F.col("r") / below))


def record_scores(spine: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """tp, np, nt, p, r, f of each record of ``spine`` (source1_entity_id and what else it has)."""
    t = truth.select("source1_entity_id", F.col("matched_id").alias("id")).distinct().withColumn("t", F.lit(1))
    p = predicted.select("source1_entity_id", F.col("candidate_id").alias("id")).distinct().withColumn("p", F.lit(1))
    counts = t.join(p, ["source1_entity_id", "id"], "full").groupBy("source1_entity_id").agg(
        F.count(F.when(F.col("t").isNotNull() & F.col("p").isNotNull(), 1)).alias("tp"), F.count("p").alias("np"), F.count("t").alias("nt")
    )
    return _scores(spine.join(counts, "source1_entity_id", "left").na.fill(0, ["tp", "np", "nt"]))


def macro_f(spine: DataFrame, truth: DataFrame, predicted: DataFrame, by: str | None = None) -> DataFrame:
    rows = record_scores(spine, truth, predicted)
    return rows.groupBy(*([by] if by else [])).agg(F.avg("f").alias("f"), F.avg("p").alias("precision"), F.avg("r").alias("recall"))


def threshold_sweep(spine: DataFrame, truth: DataFrame, scored: DataFrame, thresholds: list[float], score: str = "combined_score", by: str | None = None) -> DataFrame:
    """threshold, f, precision, recall of all thresholds in one pass; a pair adds to every threshold below its score."""
    table = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(thresholds)])
    pairs = scored.groupBy("source1_entity_id", F.col("candidate_id").alias("matched_id")).agg(F.max(score).alias("s"))
    hits = pairs.join(truth.select("source1_entity_id", "matched_id").distinct().withColumn("t", F.lit(1)), ["source1_entity_id", "matched_id"], "left")
    hits = hits.select("source1_entity_id", "s", "t", F.explode(table).alias("x")).where(F.col("s") > F.col("x.threshold"))
    counts = hits.groupBy("source1_entity_id", F.col("x.position").alias("position")).agg(F.count("t").alias("tp"), F.count(F.lit(1)).alias("np"))
    truths = truth.groupBy("source1_entity_id").agg(F.countDistinct("matched_id").alias("nt"))
    each = spine.select("source1_entity_id", *([by] if by else []), F.explode(table).alias("x")).select("source1_entity_id", *([by] if by else []), "x.position", "x.threshold")
    rows = _scores(each.join(counts, ["source1_entity_id", "position"], "left").join(truths, "source1_entity_id", "left").na.fill(0, ["tp", "np", "nt"]))
    return rows.groupBy("position", "threshold", *([by] if by else [])).agg(F.avg("f").alias("f"), F.avg("p").alias("precision"), F.avg("r").alias("recall"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the largest f, the first of equal ones."""
    return sweep.orderBy(F.desc("f"), "position").limit(1)


def blocking_recall(truth: DataFrame, candidates: DataFrame, s1: DataFrame) -> DataFrame:
    """country (null: all), n_truth, n_found, recall in percent; truth counts as a list, so repeats count."""
    hit = candidates.select("source1_entity_id", F.col("candidate_id").alias("matched_id")).distinct().withColumn("hit", F.lit(1))
    rows = truth.join(hit, ["source1_entity_id", "matched_id"], "left").join(s1.select(F.col("entity_id").alias("source1_entity_id"), "country"), "source1_entity_id", "left")
    sums = rows.rollup("country").agg(F.count(F.lit(1)).alias("n_truth"), F.count("hit").alias("n_found"), F.grouping_id().alias("level"))
    recall = F.when(F.col("n_truth") == 0, 0.0).otherwise(F.col("n_found") * 100.0 / F.col("n_truth"))
    return sums.select(F.when(F.col("level") == 1, "(all)").otherwise(F.coalesce("country", F.lit(""))).alias("country"), "n_truth", "n_found", recall.alias("recall"))


def _at(df: DataFrame, value: str, positions: dict[str, str]) -> DataFrame:
    """Values at positions of the ascending order, found from counts of distinct values rather than by a sort of all rows."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("k"))
    n = df.agg(F.count(F.lit(1)).alias("n"))
    # Distinct rounded scores or list sizes: a short table however many rows there are.
    w = Window.orderBy(value)
    ranked = counts.withColumn("upto", F.sum("k").over(w)).crossJoin(F.broadcast(n))
    return ranked.agg(*[F.min(F.when(F.col("upto") > F.expr(p), F.col(value))).alias(name) for name, p in positions.items()])


def size_stats(spine: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: mean and largest size of candidate lists, the upper median and the 95th percentile; records without any count as 0."""
    sizes = spine.join(candidates.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("size")), "source1_entity_id", "left").select(F.coalesce("size", F.lit(0)).alias("size"))
    marks = _at(sizes, "size", {"median": "floor(n / 2)", "p95": "floor(n * 0.95)"})
    return sizes.agg(F.avg("size").alias("mean"), F.max("size").alias("largest")).crossJoin(F.broadcast(marks))  # two single rows


def score_quantiles(scored: DataFrame, score: str = "combined_score") -> DataFrame:
    """One row: mean, p50, p90, p95, p99 by the nearest rank, of scores rounded to 4 digits."""
    marks = _at(scored, score, {f"p{q}": f"round((n - 1) * {q / 100})" for q in (50, 90, 95, 99)})
    return scored.agg(F.avg(score).alias("mean")).crossJoin(F.broadcast(marks))  # two single rows


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where the pair is in truth."""
    known = truth.select("source1_entity_id", F.col("matched_id").alias("candidate_id")).distinct().withColumn("_t", F.lit(1))
    return pairs.join(known, ["source1_entity_id", "candidate_id"], "left").withColumn("label", F.col("_t").isNotNull().cast("int")).drop("_t")
