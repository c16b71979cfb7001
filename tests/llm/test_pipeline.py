"""The pipeline against a plain Python version, stage by stage, on a small folder of tables."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from corvine.llm import decontamination, language_id
from corvine.llm.bpe import tokenizer_path
from corvine.llm.simhash_dedup import fingerprint

tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rnd = random.Random(12)
    kinds = {"en": "the of and to in is that for it was on are".split(), "fr": "le la les des est une que pour dans qui sur avec".split()}
    items = [" ".join(rnd.choice(kinds["en"]) + str(k) for k in range(n)) for n in (12, 30)]
    line = "This very line stands in many of the documents here"
    rows = []
    for i in range(90):
        lang = "en" if i % 2 else "fr"
        words = [rnd.choice(kinds[lang]) + rnd.choice("abcdefgh") * rnd.randrange(3) for _ in range(rnd.randrange(20, 80))]
        text = " ".join(words)
        if i % 5 == 0:
            text += "\n" + line
        if i % 11 == 0:
            text += "\n" + items[i % 2]
        rows.append((i, text, lang if i % 7 else None, "s", len(text)))
    rows += [(200 + k, rows[k * 3][1].upper(), None, "s", rows[k * 3][4]) for k in range(6)]
    rows += [(300, None, "en", "s", 0), (301, "", "fr", None, 0), (302, "123 456", "en", "s", 7), (4, *rows[4][1:])]
    return rows, [(k, t) for k, t in enumerate(items)] + [(9, None)]


def _plain(spark, rows, items):
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang"))
    docs = [(r[0], r[1]) for r in rows if not model.predict([r[1]])[0][2]]
    yield docs
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for i, t in docs:
        for x in t.split("\n"):
            holders.setdefault(key(x), set()).add(i)
    docs = [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i)) for i, t in docs]
    yield docs
    group = {i: i for i, _ in docs}
    prints = [(i, fingerprint(t)) for i, t in docs]
    for _ in docs:  # smallest id by spreading until nothing changes
        was = dict(group)
        for i, a in prints:
            for j, b in prints:
                if bin(a ^ b).count("1") <= 3:
                    group[i] = min(group[i], group[j])
        if was == group:
            break
    docs = sorted({(i, t) for i, t in docs if group[i] == i})
    yield docs
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    bench = [decontamination.words_of(t) for _, t in items if t]

    def leaks(text):
        w = decontamination.words_of(text)
        return any(decontamination.similarity(grams(w[i : i + len(b)]), grams(b)) >= 0.8 for b in bench for i in range(max(1, len(w) - len(b) + 1)))

    docs = [(i, t) for i, t in docs if not leaks(t)]
    yield docs
    known = tokenizers.Tokenizer.from_file(tokenizer_path())
    ids = [(i, known.encode(t, add_special_tokens=False).ids) for i, t in docs]
    yield [(i, len(x), tuple(x), known.decode(x, skip_special_tokens=False)) for i, x in ids]


def test_pipeline(spark, tmp_path):
    rows, items = _rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = [docs.count()]
    for (name, stage), want in zip(corpus_pipeline.STAGES, _plain(spark, rows, items), strict=True):
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got = docs.collect()
        if name == "bpe":
            assert sorted((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in got) == sorted(want)
            assert sorted(tuple(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(w[2] for w in want)
        else:
            assert sorted((r.doc_id, r.text) for r in got) == sorted(want), name
        sizes.append(len(got))
    assert sizes[0] > sizes[1] and sizes[2] > sizes[3] > sizes[4] > 0


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
