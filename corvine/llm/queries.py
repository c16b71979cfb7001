"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvine.llm import bpe, decontamination, fingerprints, hmm, language_id, license_scan, line_dedup, sharding, simhash_dedup, substring_dedup
from corvine.llm.common import documents, durable


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", simhash_dedup.hex_digits().alias("fingerprint"), "component_id")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = durable(fingerprints.compared(documents(spark, sf_dir)))
    # Search: documents with an id divisible by 20 against all. A class is the documents with one fingerprint, named by its smallest doc_id.
    classes = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("class_id"))
    met = fingerprints.within(rows.where("doc_id % 20 = 0"), classes).join(classes.hint("merge"), "fp")
    # At most 43,745 fingerprints are within 3 bits of one.
    near = met.groupBy("q").agg(F.sum("n").alias("n_within_3"), F.array_sort(F.collect_set("class_id")).alias("near_classes"))
    found = rows.join(classes.select("fp", "class_id").hint("merge"), "fp").join(near.withColumnRenamed("q", "fp").hint("merge"), "fp", "left")
    asked = F.col("doc_id") % 20 == 0
    return found.select(
        "doc_id", "n_chars", "edited_sha256", simhash_dedup.hex_digits("fp").alias("fingerprint"),
        simhash_dedup.hex_digits("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "class_id",
        F.when(asked, F.col("n_within_3")).alias("n_within_3"), F.when(asked, F.col("near_classes")).alias("near_classes"),
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    rows = language_id.predict(docs, model)
    return rows.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.trained_and_scored(documents(spark, sf_dir))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_bpe": op7_bpe,
    "op8_sharding": op8_sharding,
    "op9_license_scan": op9_license_scan,
    "op10_lm_scoring": op10_lm_scoring,
}

_OP6 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), held AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT a.doc_id, a.i, a.line, h.k IS NOT NULL AND a.doc_id <> h.keep AS gone FROM keyed a LEFT JOIN held h ON a.k = h.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""



def _op9() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    every = license_scan.TEMPLATES + license_scan.NOTICES
    values = ", ".join(f"({i}, '{label}', {sorted(set(license_scan.words_of(text)))}, {license_scan.window_of(len(license_scan.words_of(text)))})" for i, (label, text) in enumerate(every))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({low}, {word}) AS w FROM documents),
spots AS (
  SELECT doc_id, i - 1 AS i, CASE WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl'
    WHEN w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved' THEN 'reserved' END AS label
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), base AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, list_sort(list(DISTINCT label)) AS l FROM spots WHERE label IS NOT NULL GROUP BY doc_id
), t(id, label, known, n) AS (VALUES {values}),
-- A window that has the most of a template's words can start at one of them.
places AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
found AS (
  SELECT doc_id, label, len(list_intersect(w[i:i + n - 1], known)) / len(known) AS share
  FROM places JOIN (SELECT *, unnest(known) AS x FROM t) USING (x) JOIN d USING (doc_id)
  WHERE len(list_intersect(w[i:i + n - 1], known)) >= ceil({license_scan.THRESHOLD} * len(known) - 1e-9)
), more AS (SELECT doc_id, list(DISTINCT label) AS l, max(share) AS share FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
  coalesce(array_to_string(base.l, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(more.l, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


ORACLES = {"op6_line_dedup": _OP6, "op9_license_scan": _op9()}
