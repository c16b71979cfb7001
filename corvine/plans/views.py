"""Business-like records made from whole test tables and whole texts, as SQL that both Spark and DuckDB take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Whole texts: the first line is the name, all lines behind it are the address.
DOCS = """SELECT concat('S', CAST(1 + doc_id % 3 AS VARCHAR(1)), '-', CAST(doc_id AS VARCHAR(20))) AS entity_id,
       CAST(1 + doc_id % 3 AS INT) AS src, doc_id AS ord, split_part(text, '\n', 1) AS business_name,
       substring(text, length(split_part(text, '\n', 1)) + 2) AS business_address, lang AS country
FROM documents"""

PARTS = """SELECT concat('S', CAST(1 + p_partkey % 3 AS VARCHAR(1)), '-', CAST(p_partkey AS VARCHAR(20))) AS entity_id,
       CAST(1 + p_partkey % 3 AS INT) AS src, p_partkey AS ord,
       concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' & Sons Ltd' WHEN 2 THEN '' ELSE concat(' dba ', p_type) END) AS business_name,
       concat('00', CAST(p_size AS VARCHAR(20)), ' ', p_type, ' Road, ', p_brand) AS business_address,
       CASE p_size % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS country
FROM part"""

#: Documents with the same whole text and language denote the same entity.
TRUTH = """SELECT a.entity_id AS source1_entity_id, b.entity_id AS matched_id
FROM (SELECT concat('S1-', CAST(doc_id AS VARCHAR(20))) AS entity_id, lang, text AS k FROM documents WHERE doc_id % 3 = 0) a
JOIN (SELECT concat('S', CAST(1 + doc_id % 3 AS VARCHAR(1)), '-', CAST(doc_id AS VARCHAR(20))) AS entity_id, lang, text AS k
      FROM documents WHERE doc_id % 3 <> 0) b
  ON a.lang = b.lang AND a.k = b.k"""

#: Parts of the same name, brand and type denote the same entity.
PART_TRUTH = """SELECT a.entity_id AS source1_entity_id, b.entity_id AS matched_id
FROM (SELECT concat('S1-', CAST(p_partkey AS VARCHAR(20))) AS entity_id, p_name, p_brand, p_type FROM part WHERE p_partkey % 3 = 0) a
JOIN (SELECT concat('S', CAST(1 + p_partkey % 3 AS VARCHAR(1)), '-', CAST(p_partkey AS VARCHAR(20))) AS entity_id, p_name, p_brand, p_type
      FROM part WHERE p_partkey % 3 <> 0) b
  ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_type = b.p_type"""


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace(f"FROM {table}", "FROM {rows}"), rows=rows)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "documents", DOCS)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "part", PARTS)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "documents", TRUTH)


def part_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "part", PART_TRUTH)
