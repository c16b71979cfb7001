"""The jobs as commands: python -m corvine COMMAND ..., or spark-submit with this file."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from corvine.operators import metrics, retrieval, tfidf
from corvine.plans import jobs
from corvine.sources import tables


def _sides(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame]:
    one, two, three = (tables.read_parquet(spark, f"{folder}/{split}_source{n}.parquet") for n in jobs.SOURCES)
    return one, two.unionByName(three)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corvine", description=__doc__)
    p.add_argument("--split", choices=jobs.SPLITS, default="test")
    p.add_argument("--force", action="store_true", help="replace what is there")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for a in arguments:
            c.add_argument(a)
        return c

    command("normalize", "source", "target")
    command("block", "normalized", "tsv", "pairs").add_argument("--cap", type=int)
    command("fit", "normalized", "vocabulary").add_argument("--rows", type=int, default=500_000)
    c = command("score", "normalized", "pairs", "vocabulary", "features")
    c.add_argument("--buckets", type=int, default=35)
    c.add_argument("--only", type=int, help="trial: the first so many buckets")
    command("match", "normalized", "features", "tsv").add_argument("--threshold", type=float, default=0.5)
    command("evaluate", "normalized", "truth")
    command("tune", "normalized", "features", "truth")
    command("train", "normalized", "features", "truth", "model")
    command("apply", "normalized", "features", "model", "tsv").add_argument("--cache")
    c = command("variants", "normalized", "cache", "target")
    c.add_argument("specs", nargs="+")
    command("smoke", "normalized", "pairs")
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    """What the command returns: a number, names, rows as dictionaries, or None."""
    if args.command == "normalize":
        return jobs.normalize(spark, args.source, args.target, args.force)
    s1, pool = _sides(spark, args.normalized, args.split)
    rows = lambda df: [r.asDict() for r in df.collect()]
    truth = metrics.truth_pairs(tables.read_tsv(spark, args.truth, tables.TRUTH)) if "truth" in args else None
    features = tables.read_buckets(spark, args.features) if "features" in args and args.command != "score" else None
    found = tables.read_parquet(spark, args.pairs) if args.command in ("score", "smoke") else None
    match args.command:
        case "block":
            limits = retrieval.Limits() if args.cap is None else retrieval.Limits(cap=args.cap)
            return jobs.block(s1, pool, args.tsv, args.pairs, jobs.Config(limits), args.force)
        case "fit":
            for field, table in zip(("name", "address"), jobs.vocabularies([s1, pool.where("src = 2"), pool.where("src = 3")], args.rows), strict=True):
                tfidf.save_vocabulary(table, args.vocabulary, field, args.force)
        case "score":
            return jobs.score_to(found, s1, pool, args.vocabulary, args.features, args.buckets, args.only)
        case "match":
            return jobs.match(features, s1, args.tsv, args.threshold, args.force)
        case "evaluate":
            recall, sizes = jobs.evaluate(s1, pool, truth)
            return {"recall": rows(recall), "sizes": rows(sizes)}
        case "tune":
            return rows(jobs.tune(features, s1, truth))
        case "train":
            return jobs.train(features, s1, truth, args.model)
        case "apply":
            return jobs.apply(features, s1, args.model, args.tsv, args.cache, force=args.force)
        case "variants":
            try:
                trained = _sides(spark, args.normalized, "train")[0]
            except FileNotFoundError:
                trained = None
            return jobs.variants(tables.read_parquet(spark, args.cache), s1, trained, args.specs, args.target, args.force)
        case "smoke":
            return jobs.smoke(found, s1, pool)
    return None


if __name__ == "__main__":
    print(json.dumps(run(SparkSession.builder.appName("corvine").getOrCreate(), parser().parse_args()), default=str))
