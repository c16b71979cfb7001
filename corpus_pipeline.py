"""A corpus pipeline of five stages, each one of the corpus operators over all that the stage before kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Texts may be
null or empty, rows repeated, tables empty; the operators' docstrings say what becomes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvine.llm import bpe, decontamination, language_id, line_dedup, similarity_join
from corvine.llm.common import documents, durable


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID, trained on the labelled ones among them, rejects go; the labels are never read for a decision."""
    return language_id.accepted(docs, language_id.fit(docs.select("doc_id", "text", "lang")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that 5 or more documents hold stay in the largest doc_id only."""
    return line_dedup.apply(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a Jaccard similarity of 0.8 or more, by five-word shingles, the smallest doc_id stays.

    SimHash finds the pairs at 3 or fewer differing bits by its Golay keys, and they are checked on the whole sets; a join finds the others.
    """
    return similarity_join.deduplicated(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that is 0.8 or more like a benchmark item, by five-word shingles, go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from the ids."""
    return bpe.encoded(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

#: Language ID, near-dedup and BPE have no form in SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are checkpointed, as later stages read them more than once."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return docs
