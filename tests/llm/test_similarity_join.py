"""The similarity join against all pairs of shingle sets."""

import random

import pytest

import corpus_pipeline
from corvine.llm import similarity_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rnd = random.Random(5)
    draw = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    passage, texts = draw(30), []
    for size in (3, 20, 60, 150, 300):
        for _ in range(6):
            base = draw(size)
            texts.append(base)
            for edits in (1, 2, 4, 7):
                near = list(base)
                for _ in range(edits):
                    near[rnd.randrange(size)] = f"x{rnd.randrange(99)}"
                texts.append(near)
    large = draw(120)
    for _ in range(60):  # a large group of near copies, and a passage that many hold
        near = list(large)
        for _ in range(rnd.randrange(1, 5)):
            near[rnd.randrange(120)] = f"y{rnd.randrange(999)}"
        texts += [near, draw(rnd.randrange(5, 90)) + passage]
    rnd.shuffle(texts)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rows += [(900, None), (901, " \n"), (902, rows[3][1].upper()), (None, rows[5][1]), (3, rows[3][1]), (903, "one two")]
    return rows


def _grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _kept(rows):
    sets = [_grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (a and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted({k for k in least.values()})


@pytest.mark.parametrize("small", [64, 4])
def test_components(spark, small):
    rows = _rows()
    found = similarity_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), small).collect()
    assert len(found) == len(rows)
    assert sorted({r.component_id for r in found if r.component_id is not None}) == _kept(rows)


def test_stage_drops_near_copies_beyond_three_bits(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == _kept(rows)
    assert sum(r.doc_id is None for r in out) == 1


def test_large_run_over_many_batches(spark):
    rnd = random.Random(8)
    draw = lambda n: " ".join(f"v{rnd.randrange(9000)}" for _ in range(n))
    passage = draw(40)
    rows = [(i, f"{draw(4)} {passage} {draw(4)}") for i in range(150)] + [(200 + i, draw(60)) for i in range(50)]
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = similarity_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert sorted({r.component_id for r in found}) == _kept(rows)
