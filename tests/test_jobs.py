"""The jobs one after another, as commands, on a small folder of invented records."""

import random

import pytest
from pyspark.sql import functions as F

from corvine.__main__ import parser, run
from corvine.operators import pairs, retrieval, tfidf
from corvine.plans import jobs
from corvine.sources import tables

WORDS = "amber birch cedar delta ember fjord grove heron inlet jasper kelp larch mesa north onyx pike quartz ridge slate tarn umber vale".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rnd = tmp_path_factory.mktemp("records"), random.Random(3)
    for split in jobs.SPLITS:
        sides = {1: [], 2: [], 3: []}
        truth = []
        for i in range(120):
            name, street = " ".join(rnd.sample(WORDS, 3)), f"{rnd.randrange(1, 400)} {rnd.choice(WORDS)} lane {rnd.choice(WORDS)} town"
            country = rnd.choice(["US", "India", "France"] if split == "test" else ["US", "India"])
            sides[1].append((f"S1-{i}", f"{name} Inc", street, country))
            mine = []
            for side in (2, 3):
                if rnd.random() < 0.6:
                    words = name.split()
                    if rnd.random() < 0.3:
                        words[rnd.randrange(3)] = rnd.choice(WORDS)
                    sides[side].append((f"S{side}-{i}", " ".join(words) + rnd.choice([" Incorporated", "", " Ltd"]), street.title(), country))
                    mine.append(f"S{side}-{i}")
                sides[side].append((f"S{side}-{1000 + i}", " ".join(rnd.sample(WORDS, 3)), f"{rnd.randrange(1, 400)} {rnd.choice(WORDS)} road", country))
            truth.append((f"S1-{i}", ",".join(mine)))
        for side, rows in sides.items():
            lines = ["entity_id\tbusiness_name\tbusiness_address\tcountry", *("\t".join(r) for r in rows)]
            (path / f"{split}_source{side}.tsv").write_text("\n".join(lines) + "\n")
        (path / f"{split}_truth.tsv").write_text("\n".join(["source1_entity_id\tmatched_entity_ids", *("\t".join(r) for r in truth)]) + "\n")
    return path


def _run(spark, *words):
    return run(spark, parser().parse_args([str(w) for w in words]))


def _results(spark, path):
    rows = tables.read_tsv(spark, str(path), tables.TRUTH, blanks=True).collect()
    assert sorted(r.source1_entity_id for r in rows) == sorted(f"S1-{i}" for i in range(120))
    return {r.source1_entity_id: {x for x in r.matched_entity_ids.split(",") if x} for r in rows}


def test_from_files_to_variants(spark, folder):
    f = folder
    _run(spark, "normalize", f, f / "n")
    with pytest.raises(FileExistsError):
        _run(spark, "normalize", f, f / "n")
    _run(spark, "--force", "normalize", f, f / "n")
    ordered = [r.entity_id for r in spark.read.parquet(str(f / "n/test_source2.parquet")).orderBy("ord").collect()]
    assert ordered == [x.split("\t")[0] for x in (f / "test_source2.tsv").read_text().splitlines()[1:]]
    for split in jobs.SPLITS:
        n = _run(spark, "--split", split, "block", f / "n", f / f"{split}_cand", f / f"{split}_pairs", "--cap", 50)
        assert n == spark.read.parquet(str(f / f"{split}_pairs")).count() == retrieval.pairs_from_tsv(spark, str(f / f"{split}_cand")).count() > 100
    _run(spark, "fit", f / "n", f / "v", "--rows", 300)
    again = tfidf.load_vocabulary(spark, str(f / "v"), "name")
    assert again.columns[:5] == ["term", "id", "df", "total", "idf"] and again.count() > 50
    assert _run(spark, "score", f / "n", f / "test_pairs", f / "v", f / "test_f", "--buckets", 4, "--only", 1) == [0]
    trial = tables.read_buckets(spark, str(f / "test_f"))
    part = trial.count()
    assert _run(spark, "score", f / "n", f / "test_pairs", f / "v", f / "test_f", "--buckets", 4) == [1, 2, 3]
    assert _run(spark, "score", f / "n", f / "test_pairs", f / "v", f / "test_f", "--buckets", 4) == []
    assert _run(spark, "--split", "train", "score", f / "n", f / "train_pairs", f / "v", f / "train_f") == list(range(35))
    scored = tables.read_buckets(spark, str(f / "test_f"))
    ids = {tuple(r) for r in scored.select("source1_entity_id", "candidate_id").collect()}
    assert 0 < part < len(ids) == scored.count() and ids == {tuple(r) for r in spark.read.parquet(str(f / "test_pairs")).select("source1_entity_id", "candidate_id").collect()}

    _run(spark, "match", f / "n", f / "test_f", f / "m", "--threshold", 0.6)
    got = _results(spark, f / "m")
    best = {(r.source1_entity_id, r.candidate_id) for r in scored.where("combined_score > 0.6").collect()}
    assert {(a, b) for a, bs in got.items() for b in bs} == best
    sizes = _run(spark, "--split", "train", "evaluate", f / "n", f / "train_truth.tsv")
    assert next(r for r in sizes["recall"] if r["country"] == "(all)")["recall"] > 90 and sizes["sizes"][0]["largest"] <= 150
    sweep = _run(spark, "--split", "train", "tune", f / "n", f / "train_f", f / "train_truth.tsv")
    assert len(sweep) == 9 and max(r["f"] for r in sweep) > 0.8

    threshold = _run(spark, "--split", "train", "train", f / "n", f / "train_f", f / "train_truth.tsv", f / "model")
    assert 0.3 <= threshold <= 0.9
    _run(spark, "apply", f / "n", f / "test_f", f / "model", f / "a", "--cache", f / "cache")
    applied = _results(spark, f / "a")
    truth = {a: set(filter(None, b.split(","))) for a, b in (x.split("\t") for x in (f / "test_truth.tsv").read_text().splitlines()[1:])}
    right = sum(len(applied[k] & truth[k]) for k in truth)
    assert right / sum(map(len, applied.values())) > 0.8 and right / sum(map(len, truth.values())) > 0.6
    cache = spark.read.parquet(str(f / "cache"))
    assert cache.where("proba <= 0.15").count() == 0
    assert _run(spark, "variants", f / "n", f / "cache", f / "out", "0.5:0.8", "0.6") == ["matching_results_thr0p5_unseen0p8", "matching_results_thr0p6_unseen0p6"]
    country = {r.entity_id: r.country for r in spark.read.parquet(str(f / "n/test_source1.parquet")).collect()}
    want = {(r.source1_entity_id, r.candidate_id) for r in cache.collect() if r.proba > (0.8 if country[r.source1_entity_id] == "France" else 0.5)}
    assert {(a, b) for a, bs in _results(spark, f / "out/matching_results_thr0p5_unseen0p8").items() for b in bs} == want
    look = _run(spark, "smoke", f / "n", f / "test_pairs")
    assert look["pairs"] == len(ids) and len(look["best"]) == 10 and look["preview"][0.3]["n_pairs"] >= look["preview"][0.7]["n_pairs"] and look["cand_names_missing"] == 0


def test_holdout(spark):
    schema = "entity_id string, src int, ord long, business_name string"
    s1 = spark.createDataFrame([(f"S1-{i}", 1, i, "a") for i in range(5)], schema)
    s2 = spark.createDataFrame([*((f"S2-{i}", 2, i, "a") for i in range(9)), ("S2-8", 2, 20, "again")], schema)
    s3 = spark.createDataFrame([(f"S3-{i}", 3, i, "a") for i in range(9)], schema)
    truth = spark.createDataFrame([("S1-0", "S2-8"), ("S1-1", "S3-0"), ("S1-4", "S2-7")], "source1_entity_id string, matched_id string")
    some, pool, known = jobs.holdout(s1, s2, s3, truth, 2, 4)
    assert sorted(r.entity_id for r in some.collect()) == ["S1-0", "S1-1"] and known.count() == 2
    rows = sorted((r.entity_id, r.ord) for r in pool.collect())
    assert rows == [("S2-0", 0), ("S2-1", 1), ("S2-8", 8), ("S3-0", 0), ("S3-1", 1)]


def test_batches(spark):
    rows = [(f"S1-{a}", f"S2-{b}") for a in range(40) for b in range(1 + a % 7 if a else 57)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_id string").repartition(5)
    got = retrieval.with_batches(df, 10).collect()
    assert sorted((r.source1_entity_id, r.candidate_id) for r in got) == sorted(rows)
    sizes, of = {}, {}
    for r in got:
        sizes[r.part, r.batch] = sizes.get((r.part, r.batch), 0) + 1
        of.setdefault(r.source1_entity_id, set()).add((r.part, r.batch))
    assert max(sizes.values()) == 10 and all(len(b) == 1 for k, b in of.items() if k != "S1-0") and len(of["S1-0"]) >= 6
    assert sorted(len(b) for b in retrieval.pair_batches(df, 10)) == sorted(sizes.values())


def test_vectors_on_disk(spark, tmp_path):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "name string, embedding array<float>")
    pairs.save_vectors(vectors, str(tmp_path / "v"))
    assert sorted(tuple(r) for r in pairs.load_vectors(spark, str(tmp_path / "v")).collect()) == [("a", [1.0, 0.0]), ("b", [0.0, 1.0])]
    with pytest.raises(FileExistsError):
        pairs.save_vectors(vectors, str(tmp_path / "v"))


def test_cosine_against_plain_sums(spark):
    rnd = random.Random(8)
    names = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(1, 4))) for _ in range(60)] + ["", "zz"]
    texts = spark.createDataFrame([(n,) for n in names], "t string")
    vocabulary = tfidf.fit(texts, "t").cache()
    weight = {r.text_id: dict(zip(r.ids, r.weights, strict=True)) for r in tfidf.vectors(texts, "t", vocabulary).collect()}
    ids = {r.t: r.i for r in texts.select("t", tfidf.text_id(F.col("t")).alias("i")).collect()}
    pair = [(rnd.choice(names), rnd.choice(names)) for _ in range(300)] + [("zz", "zz"), ("", "")]
    got = {(r.a, r.b): r.similarity for r in tfidf.pair_cosine(spark.createDataFrame(pair, "a string, b string"), "a", "b", vocabulary).collect()}
    for a, b in pair:
        x, y = weight.get(ids[a], {}), weight.get(ids[b], {})
        assert got.get((a, b), 0.0) == pytest.approx(sum(w * y.get(k, 0.0) for k, w in x.items()))
