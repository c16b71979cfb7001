"""Pair tables and pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvine.operators import tfidf
from corvine.sources.stages import stage
from corvine.sources.tables import read_parquet, write_parquet

NAME_WEIGHT, ADDRESS_WEIGHT = 0.6, 0.4
_RAW = {"business_name": "name", "business_address": "address", "country": "country"}
_NORMALIZED = {"normalized_name": "norm_name", "normalized_address": "norm_address"}


def with_metadata(pairs: DataFrame, s1: DataFrame, pool: DataFrame, include_normalized: bool = False) -> DataFrame:
    """Names, addresses and countries of both sides beside the ids, by two left joins; columns a side lacks are left out."""
    for id_, side, df in (("source1_entity_id", "s1", s1), ("candidate_id", "cand", pool)):
        names = _RAW | (_NORMALIZED if include_normalized else {})
        own = df.select(F.col("entity_id").alias(id_), *[F.col(k).alias(f"{side}_{v}") for k, v in names.items() if k in df.columns])
        pairs = pairs.join(own, id_, "left")
    kinds = ["name", "address", "country", *(["norm_name", "norm_address"] if include_normalized else [])]
    raw, normal = kinds[:3], kinds[3:]
    columns = [f"{side}_{k}" for group in (raw, normal) for side in ("s1", "cand") for k in group]
    return pairs.select("source1_entity_id", "candidate_id", *[c for c in columns if c in pairs.columns])


def for_scoring(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Normalized texts and countries of both sides, nulls as ''."""
    keep = ["source1_entity_id", "candidate_id", "s1_norm_name", "s1_norm_address", "s1_country", "cand_norm_name", "cand_norm_address", "cand_country"]
    return with_metadata(pairs, s1, pool, include_normalized=True).select(*keep).na.fill("")


def _flags() -> dict[str, Column]:
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return {
        "name_is_missing": empty("s1_norm_name").cast("int"),
        "address_is_missing": (empty("s1_norm_address") | empty("cand_norm_address")).cast("int"),
        "country_match": (F.coalesce("s1_country", F.lit("")) == F.coalesce("cand_country", F.lit(""))).cast("int"),
    }


def features(joined: DataFrame, name_vocabulary: DataFrame, address_vocabulary: DataFrame) -> DataFrame:
    """TF-IDF similarities, flags and the combined score of a scoring input; the score is made before rounding."""
    sides = {kind: (f"s1_norm_{kind}", f"cand_norm_{kind}") for kind in ("name", "address")}
    rows = joined.withColumns({f"_{kind}_{side}": tfidf.text_id(F.col(c)) for kind, columns in sides.items() for side, c in zip("ab", columns, strict=True)})
    for kind, vocabulary in (("name", name_vocabulary), ("address", address_vocabulary)):
        a, b = sides[kind]
        texts = joined.select(F.col(a).alias("t")).distinct().unionByName(joined.select(F.col(b).alias("t")).distinct())
        ids = rows.select(F.col(f"_{kind}_a").alias("id_a"), F.col(f"_{kind}_b").alias("id_b"))
        like = tfidf.cosines(ids, stage(tfidf.vectors(texts, "t", vocabulary)))
        rows = rows.join(like.toDF(f"_{kind}_a", f"_{kind}_b", f"_{kind}"), [f"_{kind}_a", f"_{kind}_b"], "left")
    name, address = F.coalesce("_name", F.lit(0.0)), F.coalesce("_address", F.lit(0.0))
    return rows.select(
        "source1_entity_id", "candidate_id", F.bround(name, 4).alias("name_similarity"), F.bround(address, 4).alias("address_similarity"),
        *[v.alias(k) for k, v in _flags().items()], F.bround(name * NAME_WEIGHT + address * ADDRESS_WEIGHT, 4).alias("combined_score"),
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def embedding_similarity(pairs: DataFrame, left: str, right: str, vectors: DataFrame) -> DataFrame:
    """pairs with emb_name_similarity, the dot product of both names' unit vectors (name, embedding); 0 if one is unknown."""
    for side, c in (("_a", left), ("_b", right)):
        pairs = pairs.join(vectors.select(F.col("name").alias(c), F.col("embedding").alias(side)), c, "left")
    known = (F.coalesce(F.col(left), F.lit("")) != "") & (F.coalesce(F.col(right), F.lit("")) != "")
    like = F.when(known, F.bround(dot(F.col("_a"), F.col("_b")), 4))
    return pairs.withColumn("emb_name_similarity", F.coalesce(like, F.lit(0.0))).drop("_a", "_b")


def length_features(joined: DataFrame) -> DataFrame:
    """Flags and differences of lengths, which need no model."""
    n = lambda c: F.length(F.coalesce(F.col(c), F.lit("")))
    a, b = n("s1_norm_name"), n("cand_norm_name")
    rest = ["emb_name_similarity"] if "emb_name_similarity" in joined.columns else []
    return joined.select(
        "source1_entity_id", "candidate_id", *rest, *[v.alias(k) for k, v in _flags().items()],
        F.abs(a - b).cast("double").alias("name_len_diff"), (F.least(a, b) / F.greatest(a, b, F.lit(1))).alias("name_len_ratio"),
        F.abs(n("s1_norm_address") - n("cand_norm_address")).cast("double").alias("addr_len_diff"),
    )


def unique_names(*frames: DataFrame, column: str = "normalized_name") -> DataFrame:
    """Distinct names that aren't empty, over all frames."""
    out = frames[0].select(F.col(column).alias("name"))
    for f in frames[1:]:
        out = out.unionByName(f.select(F.col(column).alias("name")))
    return out.where(F.octet_length("name") > 0).distinct()


def build_name_vectors(names: DataFrame, encode, batch_size: int = 256) -> DataFrame:
    """(name, embedding) by an encoder list[str] -> array (n, d), applied to batches; vectors are scaled to length one."""
    import numpy as np
    import pandas as pd

    def run(frames):
        for pdf in frames:
            for at in range(0, len(pdf), batch_size):
                part = pdf["name"].iloc[at : at + batch_size]
                v = np.asarray(encode(part.tolist()), np.float32)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                yield pd.DataFrame({"name": part.to_numpy(), "embedding": list(v)})

    return names.select("name").mapInPandas(run, "name string, embedding array<float>")


def save_vectors(vectors: DataFrame, path: str, force: bool = False) -> None:
    write_parquet(vectors.select("name", "embedding"), path, force)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(name, embedding) as ``save_vectors`` wrote it."""
    return read_parquet(spark, path, ["name", "embedding"])
