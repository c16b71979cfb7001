"""Decontamination against every window of every document."""

import random
from collections import Counter

from corvine.llm import decontamination as d


def _brute(docs, items, threshold):
    out = {}
    classes = {}
    for i, t in items:
        if w := d.words_of(t):
            classes.setdefault(tuple(w), []).append(i)
    for doc, text in docs:
        words = d.words_of(text)
        for item, ids in classes.items():
            s, n = min(5, len(item)), len(item)
            grams = lambda w, s=s: Counter(tuple(w[i : i + s]) for i in range(len(w) - s + 1))
            best = max((d.similarity(a, grams(item)) for i in range(max(1, len(words) - n + 1)) if (a := grams(words[i : i + n]))), default=0)
            if best >= threshold:
                out[doc, min(ids)] = best
    return out


def _made():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 7))) for _ in range(300)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [text(rnd.randrange(3, 60)) for _ in range(30)]
    docs = []
    for k in range(120):
        words = text(rnd.randrange(0, 200))
        if k % 2:
            leak = list(rnd.choice(items))
            for _ in range(k // 2 % 4):
                leak[rnd.randrange(len(leak))] = "changed"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = leak
        docs.append((k, (", " if k % 3 else "\n").join(words).title()))
    bench = [(i, " ".join(x)) for i, x in enumerate(items)]
    return docs, [*bench, (99, bench[4][1].upper())]


def test_all_windows(spark):
    docs, items = _made()
    docs += [(500, None), (501, ""), (502, " ".join(["same words here again now"] * 30))]
    items += [(100, None), (101, "..."), (102, "same words here again now same words here")]
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.contaminated(frame, bench).collect()}
    want = _brute(docs, items, 0.8)
    assert {k: round(r.similarity, 9) for k, r in got.items()} == {k: round(v, 9) for k, v in want.items()}
    assert all(r.n_items == 1 + (k[1] == 4) for k, r in got.items())
    kept = {r.doc_id for r in d.clean(frame, bench).select("doc_id").collect()}
    assert kept == {k for k, _ in docs} - {k for k, _ in want}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item_id long")
    some = spark.createDataFrame([(1, "a b c d e f", 1), (1, "a b c d e f", 1), (None, "a b c d e f", 2)], "doc_id long, text string, item_id long")
    assert d.contaminated(none, some).collect() == [] and d.contaminated(some, none).collect() == []
    assert d.clean(some, none).count() == 3
    assert sorted((r.doc_id or -1, r.item_id) for r in d.contaminated(some, some).collect()) == [(-1, 1), (1, 1), (1, 1)]
