"""Record-linkage operators on small tables."""

import pytest
from pyspark.sql import functions as F

from corvine.functions.keys import address_keys, clean_country, name_keys
from corvine.functions.text import normalize_frame, normalize_text
from corvine.operators import decision, metrics, pairs, retrieval, tfidf
from corvine.plans import validate
from corvine.sources import tables

SOURCE = "entity_id string, src int, ord long, business_name string, business_address string, country string"


def _values(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def _frame(spark, rows):
    return normalize_frame(spark.createDataFrame([(e, int(e[1]), i, n, a, c) for i, (e, n, a, c) in enumerate(rows)], SOURCE))


def _lists(spark, s1, pool, **limits):
    got = retrieval.compact(s1, retrieval.retrieve(s1, pool, retrieval.Limits(**{"cap": 150, **limits})))
    return {r.source1_entity_id: r.candidate_entity_ids for r in got.collect()}


def test_normalization(spark):
    texts = [None, "", "  Forêt-Légère & Sœurs S.A.R.L. ", "ACME Co., Ltd", "ﬁne　ＡＢＣ", "a$b + c|d", "x\x1cy\x85z", "नदी पुस्तक"]
    want = ["", "", "forêt légère and sœurs s a r l", "acme company limited", "fine abc", "a$b + c|d", "x y z", "नदी पुस्तक"]
    assert _values(spark, normalize_text, texts) == want
    assert _values(spark, lambda c: normalize_text(c, canonicalize_suffixes=False), ["A Co"]) == ["a co"]
    with pytest.raises(ValueError, match="business_address"):
        normalize_frame(spark.createDataFrame([("a",)], "business_name string"))


def test_name_keys(spark):
    names = ["Quartz Ferry", "Quartz Ferry Inc.", "Tamsin's Bookbinding", "Bookbinding Tamsin's", "Forêt-Légère & Sœurs S.A.R.L.", "नदी पुस्तक भंडार", "", None, "The Company"]
    one, two, three, four, five, six, empty, none, stop = _values(spark, name_keys, _values(spark, normalize_text, names))
    assert "NF_quar" in one and "NF_quar" in two and "NS_book" in three and "NS_book" in four and "NF_forê" in five
    assert any(k.startswith("NF_") for k in six) and empty == [] and none == []
    assert stop == ["NF_the", "NS_comp", "NS2_the"]
    alias, plain = _values(spark, name_keys, ["ostrava dba meridel pottery incorporated", "meridel pottery incorporated"])
    assert "NF_meri" in alias and "NF_meri" in plain and "NF_ostr" in alias
    (keys,) = _values(spark, name_keys, ["smt malati weavers india private limited"])
    assert any(k.endswith("_mala") for k in keys) and not any(k.endswith(("_smt", "_indi")) for k in keys)


def test_address_keys(spark):
    a, b, empty, none, words, digits = _values(
        spark, address_keys,
        _values(spark, normalize_text, ["PORT ANSEL, OR, 0048213 WILLET ROAD", "48213 Willet Rd, Port Ansel, Oregon", "", None, "Heron Quay Block A, Silverford, Lower Vale", "१२ marg heron quay"]),
    )
    assert "ANW_48213_will" in a and "ANW_48213_will" in b and empty == [] and none == []
    assert any(k.startswith("AWP_") for k in words) and not any(k.startswith("ANW_") for k in words)
    assert "ANW_12_marg" in digits
    x, y = _values(spark, address_keys, ["unit 314 8806 lantern hill", "8806 lantern hill 314"])
    assert set(x) & set(y)
    x, y = _values(spark, address_keys, ["571 juniper field lane", "juniper field lane"])
    assert any(k.startswith("AWP_") for k in set(x) & set(y))


def test_country(spark):
    assert _values(spark, clean_country, [" US ", None, "New  Zealand"]) == ["US", "", "New  Zealand"]


def test_countries_never_mix(spark):
    s1 = _frame(spark, [("S1-1", "Copper Wren", "", "US"), ("S1-2", "Copper Wren", "", "India"), ("S1-3", "Copper Wren", "", "Japan"), ("S1-4", "Copper Wren", "", None)])
    pool = _frame(spark, [("S2-1", "Copper Wren", "", "US"), ("S3-1", "Copper Wren Inc", "", "India"), ("S2-2", "Copper Wren", "", None)])
    assert _lists(spark, s1, pool) == {"S1-1": "S2-1", "S1-2": "S3-1", "S1-3": "", "S1-4": "S2-2"}


def test_cap_and_oversize(spark):
    s1 = _frame(spark, [("S1-1", "Copper Wren", "12 Juniper Field", "US")])
    pool = _frame(spark, [(f"S2-{i:02}", "Copper Wren", "12 Juniper Field", "US") for i in range(10)])
    assert _lists(spark, s1, pool, cap=3) == {"S1-1": "S2-00,S2-01,S2-02"}
    assert _lists(spark, s1, pool, max_block=10) == {"S1-1": ",".join(f"S2-{i:02}" for i in range(10))}
    assert _lists(spark, s1, pool, max_block=9, sample=4) == {"S1-1": "S2-00,S2-01,S2-02,S2-03"}


def _sequential(keys, blocks, limits):
    out = []
    for k in keys:
        ids = blocks.get(k, [])
        if ids and len(ids) <= limits.max_block:
            out += [c for c in ids if c not in out]
        elif ids and not out:
            out += ids[: limits.sample]
    return out[: limits.cap]


def test_retrieval_against_one_record_at_a_time(spark):
    import random

    rnd = random.Random(2)
    words = ["blue", "fox", "iron", "gate", "sun", "peak", "mill", "oak"]
    row = lambda e: (e, " ".join(rnd.choices(words, k=3)), f"{rnd.randrange(1, 4)} {rnd.choice(words)} {rnd.choice(words)}", rnd.choice(["US", "FR"]))
    s1, pool = _frame(spark, [row(f"S1-{i}") for i in range(40)]), _frame(spark, [row(f"S{2 + i % 2}-{i}") for i in range(200)])
    limits = retrieval.Limits(cap=12, max_block=25, sample=5)
    keyed = {}
    for df, target in ((s1, "s1"), (pool, "pool")):
        for r in sorted(retrieval.record_keys(df).collect(), key=lambda r: (r.src, r.ord, r.pos)):
            keyed.setdefault(target, {}).setdefault(r.entity_id, []).append((r.country, r.block_key))
    blocks = {}
    for e, ks in keyed["pool"].items():
        for k in ks:
            blocks.setdefault(k, []).append(e)
    want = {e: ",".join(_sequential(ks, blocks, limits)) for e, ks in keyed["s1"].items()}
    got = {r.source1_entity_id: r.candidate_entity_ids for r in retrieval.compact(s1, retrieval.retrieve(s1, pool, limits)).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_pairs_and_batches(spark):
    s1 = _frame(spark, [("S1-1", "A", "x", "US"), ("S1-2", "B", "y", "US"), ("S1-3", "C", "z", "US")])
    pool = _frame(spark, [("S2-1", "A a", "x", "US"), ("S2-2", "B b", "y", "US"), ("S3-3", "C c", "z", "US")])
    compacted = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", "S3-3"), ("S1-3", "")], "source1_entity_id string, candidate_entity_ids string")
    found = retrieval.id_pairs(compacted)
    table = pairs.with_metadata(found, s1, pool)
    assert table.columns == ["source1_entity_id", "candidate_id", "s1_name", "s1_address", "s1_country", "cand_name", "cand_address", "cand_country"]
    assert table.count() == 3 and len(pairs.with_metadata(found, s1, pool, True).columns) == 12
    assert [len(b) for b in retrieval.pair_batches(found, 2)] == [2, 1]


def test_tsv(spark, tmp_path):
    rows = spark.createDataFrame([("S1-001", "S2-1,S3-2"), ("S1-002", "")], "source1_entity_id string, candidate_entity_ids string").coalesce(1)
    path = str(tmp_path / "out")
    tables.write_tsv(rows, path)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == "source1_entity_id\tcandidate_entity_ids\nS1-001\tS2-1,S3-2\nS1-002\t\n"
    with pytest.raises(FileExistsError):
        tables.write_tsv(rows, path)
    tables.write_tsv(rows, path, force=True)
    assert tables.read_tsv(spark, path, tables.CANDIDATES, blanks=True).orderBy("source1_entity_id").collect()[1].candidate_entity_ids == ""
    with pytest.raises(FileNotFoundError):
        tables.read_tsv(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="business_name"):
        tables.read_tsv(spark, path)
    assert tables.write_in_buckets(rows, str(tmp_path / "b"), "source1_entity_id", 3) == [0, 1, 2]
    assert tables.write_in_buckets(rows, str(tmp_path / "b"), "source1_entity_id", 3) == []


def test_tfidf_short_words(spark):
    rows = _values(spark, tfidf.grams, ["", "a", "ab", "abcd", "a b"])
    assert rows == [[], [" a "], [" ab", "ab ", " ab "], [" ab", "abc", "bcd", "cd ", " abc", "abcd", "bcd ", " abcd", "abcd "], [" a ", " b "]]


def test_macro_f(spark):
    spine = spark.createDataFrame([(f"S1-{i}",) for i in range(5)], "source1_entity_id string")
    truth = spark.createDataFrame([("S1-1", "a"), ("S1-3", "a"), ("S1-3", "b"), ("S1-4", "a")], "source1_entity_id string, matched_id string")
    scored = spark.createDataFrame([("S1-2", "S2-x", 0.9), ("S1-3", "a", 0.9), ("S1-3", "c", 0.9), ("S1-4", "a", 0.5)], "source1_entity_id string, candidate_id string, combined_score double")
    predicted = scored.where("combined_score > 0.4")
    row = metrics.macro_f(spine, truth, predicted).first()
    # nothing on either side 1; truth only 0; prediction only 0; partial 0.5; exact 1
    assert row.f == pytest.approx((1 + 0 + 0 + 0.5 + 1) / 5) and row.precision == pytest.approx(2.5 / 5) and row.recall == pytest.approx(2.5 / 5)
    sweep = {r.threshold: r.f for r in metrics.threshold_sweep(spine, truth, scored, [0.4, 0.5, 0.95]).collect()}
    assert sweep[0.4] == pytest.approx(0.5) and sweep[0.5] == pytest.approx(1.5 / 5) and sweep[0.95] == pytest.approx(2 / 5)
    assert metrics.best_threshold(metrics.threshold_sweep(spine, truth, scored, [0.4, 0.41, 0.5])).first().threshold == 0.4


def test_strict_threshold_and_prefix(spark):
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-1", "S3-2", 0.51), ("S1-1", "S2-9", 0.9), ("S1-1", "S1-4", 0.9)], "source1_entity_id string, candidate_id string, combined_score double")
    spine = spark.createDataFrame([("S1-1",), ("S1-2",)], "source1_entity_id string")
    assert {tuple(r) for r in decision.match(scored, spine, 0.5).collect()} == {("S1-1", "S2-9,S3-2"), ("S1-2", "")}


def test_truth_and_unseen(spark):
    truth = spark.createDataFrame([("S1-1", " a, ,b "), ("S1-2", None), ("S1-3", "")], "source1_entity_id string, matched_entity_ids string")
    assert {tuple(r) for r in metrics.truth_pairs(truth).collect()} == {("S1-1", "a"), ("S1-1", "b")}
    test = spark.createDataFrame([("US",), (None,), ("JP",)], "country string")
    assert [r.country for r in decision.unseen_countries(test, test.where("country = 'US'")).collect()] == ["JP"]
    assert decision.unseen_countries(test, None).count() == 2 and decision.variant_name(0.5, 0.65) == "thr0p5_unseen0p65"


def test_validation(spark):
    s1 = _frame(spark, [("S1-1", "A", "x", "US"), ("S1-2", "B", "y", "US")])
    pool = _frame(spark, [("S2-1", "A", "x", "US")])
    results = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-9", "S1-1")], "source1_entity_id string, matched_entity_ids string")
    found = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, candidate_id string")
    got = {r.rule: r.n for r in validate.violations(results, s1, pool, found).collect()}
    assert got == {"record_missing": 1, "record_unknown": 1, "record_repeated": 0, "id_repeated": 1, "id_prefix": 1, "id_unknown": 1, "not_a_candidate": 1}


def test_vectors(spark):
    names = pairs.unique_names(spark.createDataFrame([("a",), ("b",), ("",)], "normalized_name string"), spark.createDataFrame([("a",)], "normalized_name string"))
    vectors = pairs.build_name_vectors(names, lambda texts: [[len(t), ord(t[0]) - 96] for t in texts])
    asked = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "z"), ("", "a")], "x string, y string")
    got = {(r.x, r.y): r.emb_name_similarity for r in pairs.embedding_similarity(asked, "x", "y", vectors).collect()}
    assert got == {("a", "b"): pytest.approx(0.9487), ("a", "a"): pytest.approx(1.0), ("a", "z"): 0.0, ("", "a"): 0.0}
