"""Corpus operators against plain Python on small tables with nulls, empties, ties, repeats and clashing column names."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corvine.llm import components, fm_index, hmm, language_id, license_scan, line_dedup, sharding, simhash_dedup, substring_dedup

ODD = "doc_id long, text string, lang string, bucket string, n_chars long, fp string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "b", len(t or ""), "f") for i, t in rows], ODD)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- line dedup ----


def _lines(seed=1):
    rnd = random.Random(seed)
    common = [f"{c * 20} a line that is long enough to count {c}" for c in "abcde"]
    rows = []
    for i in range(60):
        lines = [rnd.choice(["", "short", f"  {rnd.choice(common).upper()}\t", rnd.choice(common), f"only here {i} " * 5]) for _ in range(rnd.randrange(1, 9))]
        rows.append((i * 3, "\n".join(lines)))
    return [*rows, (1000, None), (1001, ""), (1002, common[0] + "\n" + common[0])]


def test_line_dedup(spark):
    rows = _lines()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(i)
    want = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == i]
        want[i] = (len(lines), len(lines) - len(keep), _sha("\n".join(keep)))
    docs = _frame(spark, rows)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(docs).collect()} == want
    maps = {r.did: r.keep_bitmap for r in line_dedup.keep_bitmaps(docs).collect()}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = line_dedup.kept_lines(lines, maps.get(i))
        assert (len(lines), len(lines) - len(kept), _sha("\n".join(kept))) == want[i] and (i in maps) == (len(kept) < len(lines))
    out = line_dedup.apply(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: _sha(r.text or "") for r in out.collect()} == {i: sha for i, (_, _, sha) in want.items()}
    assert line_dedup.digests(docs.limit(0)).collect() == []


def test_line_dedup_tells_rows_apart(spark):
    common = "This line stands in more than five of the documents"
    unique = "\n".join(f"unique line {i} that is nowhere else at all, number {i}" for i in range(3))
    rows = [*((i, common) for i in range(8)), (2, unique), (2, common), (None, common), (None, unique), (None, "short"), (7, f"{common}\n{unique}")]
    docs = _frame(spark, rows)
    want = sorted((str(i), "" if t == common and i != 7 else t) for i, t in rows)
    assert sorted((str(r.doc_id), r.text) for r in line_dedup.apply(docs).collect()) == want
    assert sorted((str(r.doc_id), r.kept_sha256) for r in line_dedup.digests(docs).collect()) == sorted((i, _sha(t)) for i, t in want)
    long = "\n".join([common, *(f"{k} and so on for forty characters and more" for k in range(40_000)), common.upper() + " "])
    (got,) = line_dedup.digests(_frame(spark, [*rows, (1, long)])).where(f"n_lines = {long.count(chr(10)) + 1}").collect()
    assert got.n_dropped == 2


# ---- sharding ----


def test_sharding(spark):
    rows = [(None, "x"), (None, None), (5, "é"), (5, "é"), *((i * 11, "t" * i) for i in range(300))]
    got = sharding.assign(_frame(spark, rows)).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted(r.row_number for r in got) == list(range(len(rows)))
    again = sharding.assign(_frame(spark, rows[::-1]).repartition(7))
    assert {(r.row_number, r.shard, r.slot) for r in again.collect()} == {(r.row_number, r.shard, r.slot) for r in got}
    assert sharding.assign(_frame(spark, rows).limit(0)).collect() == [] and sharding.assign(_frame(spark, rows[:1])).count() == 1


# ---- near-dedup ----


def _fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    votes = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(grams))


def test_near_duplicates(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(400)] for _ in range(12)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for k in range(60):
        b = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            b[rnd.randrange(400)] = word()
        rows.append((100 + k, " ".join(b).title() if k % 2 else "\n".join(b)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "One two"), (504, "one TWO"), (7, rows[7][1])]
    prints = [_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    want = sorted((d, prints[i], least[root(i)]) for i, (d, _) in enumerate(rows))
    docs = _frame(spark, rows)
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_dedup.near_duplicates(docs).collect())
    assert got == want
    kept = simhash_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert simhash_dedup.near_duplicates(docs.limit(0)).collect() == []
    far = 1 << 62
    shared = [(2, "a b c d"), (2, "q r s t"), (9, "A b c d"), (None, "q R s t"), (None, "l m n o"), (None, "L m n o"), (far, "u v w x"), (far + 1, "u v w x"), (far, "u v w x")]
    found = {(r.doc_id, r.component_id) for r in simhash_dedup.near_duplicates(_frame(spark, shared)).collect()}
    assert found == {(2, 2), (9, 2), (None, 2), (None, None), (far, far), (far + 1, far)}
    kept = sorted((str(r.doc_id), r.text.lower()) for r in simhash_dedup.deduplicated(_frame(spark, shared)).collect())
    assert kept == sorted([("2", "a b c d"), ("2", "q r s t"), (str(far), "u v w x"), *[("None", x) for x in ("q r s t", "l m n o", "l m n o")]])
    nulls = simhash_dedup.near_duplicates(_frame(spark, [(None, "a b c d"), (None, "x y z w"), (3, "a b c d")])).collect()
    assert sorted(str(r.component_id) for r in nulls) == ["3", "3", "None"]


def test_golay_keys_meet_every_pair_within_three():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    met = {}
    for key, who, side in zip(*(x.tolist() for x in simhash_dedup.keys_of(np.r_[a, b])), strict=True):
        met.setdefault(key, []).append((who, side))
    found = {(x, y) for v in met.values() for x, s in v for y, t in v if x < y and (s == 0 or s != t)}
    assert all((i, i + len(a)) in found for i in range(len(a)))
    assert len(np.unique(simhash_dedup.golay_index())) == 4096


def test_long_runs_link_like_short_ones():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 3), replace=False)) for x in np.repeat(seeds, 20)]
    fps = np.unique(np.array(fps, np.uint64))
    side = rng.integers(0, 3, len(fps)).astype(np.int8)

    def groups(pairs):
        root = list(range(len(fps)))
        for a, b in pairs:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        out = []
        for x in range(len(fps)):
            while root[x] != x:
                x = root[x]
            out.append(x)
        return out

    assert len(fps) > simhash_dedup.SHORT
    assert groups(simhash_dedup.forest(fps, side, 3)) == groups(simhash_dedup._spanning(fps, side, 3, np.arange(len(fps))))


def test_long_texts_are_fingerprinted_in_blocks():
    text = " ".join(f"w{i * i % 977}" for i in range(40_000))
    assert simhash_dedup.fingerprint(text) == _fingerprint(text)


def test_components(spark):
    rnd = random.Random(6)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


# ---- substring dedup ----


def test_fm_index_counts():
    rng = np.random.default_rng(2)
    seqs = [rng.integers(1, 4, rng.integers(1, 40)) for _ in range(25)]
    weights = rng.integers(1, 3, len(seqs))
    index = fm_index.FMIndex(seqs, weights, 4)
    ends = np.concatenate([s + np.arange(1, len(x) + 1) for s, x in zip(index.starts, seqs, strict=True)])
    got = iter(index.matching(ends, 6).tolist())
    grams = Counter()
    for x, w in zip(seqs, weights.tolist(), strict=True):
        for n in range(1, 7):
            for i in range(len(x) - n + 1):
                grams[tuple(x[i : i + n].tolist())] += w
    for x in seqs:
        for e in range(1, len(x) + 1):
            best = max((n for n in range(1, min(6, e) + 1) if grams[tuple(x[e - n : e].tolist())] >= 2), default=0)
            assert next(got) == best


@pytest.mark.parametrize("shard_words", [100, 400_000])
def test_substring_dedup(spark, shard_words):
    rnd = random.Random(8)
    word = lambda: rnd.choice("abcdefghijklmnop") * rnd.randrange(1, 3)
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rnd.randrange(0, 120))]
        if i % 3 == 0:
            at, a = rnd.randrange(len(words) + 1), rnd.randrange(20)
            words[at:at] = passage[a : a + rnd.randrange(30, 60)]
        rows.append((i, ("\n" if i % 2 else "  ").join(words)))
    rows += [(100, None), (101, ""), (102, "x " * 90), (103, rows[0][1]), (3, rows[3][1])]
    window = 35
    split = [[w for w in (t or "").replace("\n", " ").split(" ") if w] for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    want = []
    for (d, _), w in zip(rows, split, strict=True):
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        want.append((d, len(w), len(gone), _sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    docs = _frame(spark, rows)
    got = [tuple(r) for r in substring_dedup.digests(docs, shard_words=shard_words).collect()]
    assert sorted(got) == sorted(want)
    if shard_words > 100:
        full = substring_dedup.removed(docs).collect()
        assert all(sum(x.last - x.first + 1 for x in r.intervals) == r.n_removed for r in full)
        assert substring_dedup.digests(docs.limit(0)).collect() == []


def test_substring_dedup_of_null_ids_and_long_texts(spark):
    rnd = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(50))
    long = [f"{rnd.randrange(10**9)}" for _ in range(70_000)]
    rows = [(None, f"a {passage} b"), (None, f"c {passage}"), (None, None), (7, " ".join([*long, passage, *long[:35]])), (7, "only here")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.digests(_frame(spark, rows)).collect())
    assert got == sorted([("None", 52, 50), ("None", 51, 50), ("None", 0, 0), ("7", 70_085, 120), ("7", 2, 0)])


# ---- language ID ----


def _predicted(model, text):
    """Label and score by loops over n-grams, centroids and labels."""
    raw = language_id.letters(text)
    count = Counter()
    for n in range(1, language_id.ORDERS + 1):
        for i in range(len(raw) - n + 1):
            code = 0
            for b in raw[i : i + n]:
                code = (code * 257 + b + 1) % 2**32
            count[(code * 2654435769) % 2**32 >> 18] += 1
    v = {k: (1 + math.log(c)) * float(model.idf[k]) for k, c in count.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    best = {}
    for c, label in zip(model.centroids, model.label_of, strict=True):
        best[label] = max(best.get(label, -1.0), sum(x * float(c[k]) for k, x in v.items()) / size)
    top = max(best, key=lambda i: (best[i], -i))
    share = [math.exp(language_id.SHARPNESS * (x - best[top])) for x in best.values()]
    return model.labels[top], 1 / sum(share)


def test_language_id(spark):
    rnd = random.Random(9)
    kinds = {"en": "the of and to in is that for it was on are".split(), "fr": "le la les des est une que pour dans qui sur avec".split(), "de": "der die und das ist nicht ein mit für auf den".split()}
    rows = [(i, " ".join(rnd.choice(kinds[lang]) for _ in range(rnd.randrange(8, 60))), lang) for i, lang in enumerate(["en", "fr", "de"] * 80)]
    odd = [(900, None, "en"), (901, "", "fr"), (902, "12 !!", "de"), (903, "the of and", None), (3, rows[3][1], "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, lang string, score string")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predict(docs, model).collect()
    by = {r.doc_id: r for r in got}
    tested = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(tested) > 30 and sum(by[i].lang_pred == lang for i, lang in tested) >= 0.95 * len(tested)
    assert all((by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True) for i in (900, 901, 902))
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 2
    for text in [rows[0][1], rows[1][1], "der die the of", "x" * 50_000]:
        assert model.predict([text])[0][:2] == pytest.approx(_predicted(model, text))
    copies = docs.where("doc_id % 2 = 0").withColumn("doc_id", F.lit(None).cast("long"))
    many = copies.where("text is not null").limit(1).crossJoin(spark.range(3000)).drop("id")
    again = language_id.fit(copies.unionByName(many))
    assert again.labels == model.labels and {r.lang_pred for r in language_id.predict(many, again).collect()} <= {*model.labels}
    none = language_id.fit(docs.where("lang is null"))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).collect() == []


# ---- licenses ----


def test_license_scan(spark):
    texts = [None, "", "CC BY CC-BY cc by", "x\nLicensed under the apache license, version 2.0!\n" + "filler " * 50, "General\nPublic License", "mit license released under the", "All  rights*reserved", "the license under", "K cc by"]
    docs = _frame(spark, list(enumerate(texts)) + [(None, "cc by")])
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert [(got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in (0, 1, 2, 4, 6)] == [(0, None, None, ""), (0, None, None, ""), (3, 0, 4, "cc-by"), (1, 0, 0, "gpl"), (1, 0, 0, "reserved")]
    assert got[3].labels == "apache" and got[3].score == 1.0 and got[3].n_base == 0
    assert got[5].labels == "mit" and got[7].labels == "" and got[7].score == 0.0 and got[None].labels == "cc-by" and got[8].first_word == 1
    assert len(got) == len(texts) + 1 and license_scan.scan(docs.limit(0)).collect() == []


# ---- LM scoring ----


@pytest.mark.parametrize("piece", [2, 3, 512])
def test_hmm_forward_and_counts_against_loops(piece, monkeypatch):
    monkeypatch.setattr(hmm, "PIECE", piece)
    rng = np.random.default_rng(3)
    k, s = 3, 7
    model = hmm.Model([b"a"], np.ones(1, np.int64), np.zeros(s - 1), 1, 1, rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T)
    seqs = [rng.integers(0, s, n).astype(np.int32) for n in (1, 5, 3, 5, 9)]
    starts, moves, emissions, likelihood = hmm.expected(model, seqs)
    got = hmm.forward(model, seqs)
    assert likelihood == pytest.approx(got.sum(), rel=1e-5)
    total = [np.zeros(k), np.zeros((k, k)), np.zeros((s, k))]
    for x, score in zip(seqs, got, strict=True):
        f = [model.start * model.emit[x[0]]]
        for y in x[1:]:
            f.append((f[-1] @ model.move) * model.emit[y])
        b = [np.ones(k)]
        for y in x[:0:-1]:
            b.insert(0, model.move @ (model.emit[y] * b[0]))
        p = f[-1].sum()
        assert score == pytest.approx(math.log10(p))
        for t, y in enumerate(x):
            gamma = f[t] * b[t] / p
            total[2][y] += gamma
            if not t:
                total[0] += gamma
            if t + 1 < len(x):
                total[1] += f[t][:, None] * model.move * (model.emit[x[t + 1]] * b[t + 1])[None] / p
    for mine, want in zip((starts, moves, emissions), total, strict=True):
        np.testing.assert_allclose(mine, want, rtol=2e-5, atol=1e-6)


def test_hmm_scores(spark):
    rnd = random.Random(10)
    rows = [(i, " ".join(rnd.choice(["the", "Of", "AND", "x" * 40, f"w{rnd.randrange(50)}"]) for _ in range(rnd.randrange(0, 30)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "the of"), (5, "the of"), (5, "the of")]
    docs = _frame(spark, rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in hmm.trained_and_scored(docs).collect())
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").lower().split(), None]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert got == want
    assert hmm.trained_and_scored(docs.limit(0)).collect() == []


def test_hmm_is_a_distribution_and_joins_rare_words(spark):
    rows = [(i, f"a b c rare{i} a") for i in range(40)]
    docs = _frame(spark, rows)
    counts = hmm.word_counts(docs).cache()
    model = hmm.vocabulary(counts, own=3)
    seqs = hmm.coded(docs, model)
    model = hmm.train(seqs, model, states=2, rounds=13, tolerance=0.0)
    assert sorted(model.words) == [hmm.END, b"a", b"b", b"c"]
    assert model.emit.sum(0) == pytest.approx(1) and model.move.sum(1) == pytest.approx(1)
    got = {r.doc_id: r for r in hmm.score(docs, seqs, model, counts).collect()}
    n, v = 240, 44
    base = 2 * math.log10(81 / (n + v + 1)) + 3 * math.log10(41 / (n + v + 1)) + math.log10(2 / (n + v + 1))
    assert all(r.base_score == pytest.approx(base) and r.n_known == 6 for r in got.values())
    assert all(r.score > r.base_score for r in got.values())


def _plain_score(model, totals, counts, tokens):
    """log10 probability of one text, symbol by symbol and state by state."""
    own = {w: i for i, w in enumerate(model.words)}
    a, out = None, 0.0
    for w in tokens:
        e = model.emit[own.get(w, len(own) + hmm.class_of(w))]
        a = [model.start[j] * e[j] if a is None else sum(a[i] * model.move[i][j] for i in range(len(e))) * e[j] for j in range(len(e))]
        out += math.log10(sum(a)) + (0 if w in own else math.log10((counts[w] + 1) / (totals[hmm.class_of(w)] + 1)))
        a = [x / sum(a) for x in a]
    return out


def test_hmm_score_against_one_text_at_a_time(spark):
    rnd = random.Random(12)
    texts = [" ".join(rnd.choice(["the", "Of", "AND", "\u00e9t\u00e9", f"w{rnd.randrange(300)}", "y" * 40 + str(rnd.randrange(9))]) for _ in range(rnd.randrange(0, 40))) for _ in range(90)]
    texts += [None, "", " \n", " a\x0bb\x0cc\xa0d\x85e ", " ".join(f"w{rnd.randrange(300)}" for _ in range(3000))]
    docs = _frame(spark, [*enumerate(texts), (None, "the of"), (None, "w1 new"), (5, texts[5])])
    training = docs.where(~hmm.held_out())
    counts = hmm.word_counts(training).cache()
    model = hmm.vocabulary(counts, own=20)
    seqs = hmm.coded(docs, model)
    model = hmm.train(seqs.where(~hmm.held_out()), model, states=3, rounds=3)
    tokens = lambda t: [*(t or "").encode().lower().split(), hmm.END]
    c = Counter(w for r in training.collect() for w in tokens(r.text))
    plain = sorted((w for w in c if w != hmm.END and len(w) <= 32), key=lambda w: (-c[w], w))[:20]
    assert set(model.words) == {*plain, hmm.END}
    totals = Counter()
    for w, n in c.items():
        if w not in model.words:
            totals[hmm.class_of(w)] += n + 1
    want = sorted((str(r.doc_id), round(_plain_score(model, totals, c, tokens(r.text)), 6)) for r in docs.collect())
    got = sorted((str(r.doc_id), round(r.score, 6)) for r in hmm.score(docs, seqs, model, counts).collect())
    assert [x[0] for x in got] == [x[0] for x in want]
    np.testing.assert_allclose([x[1] for x in got], [x[1] for x in want], rtol=1e-6, atol=1e-5)


def test_hmm_vocabulary_of_equal_counts(spark):
    counts = spark.createDataFrame([(f"w{i:04}".encode(), hmm.class_of(f"w{i:04}".encode()), 3) for i in range(500)], "key binary, cls int, c long")
    assert hmm.vocabulary(counts, own=7).words == [*(f"w{i:04}".encode() for i in range(7)), hmm.END]
    assert len(hmm.vocabulary(counts).words) == math.ceil(hmm.SPREAD * math.sqrt(1500)) + 1
