"""Every round of Baum-Welch sees all training documents; rounds end when the likelihood hardly grows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from corvine.llm import hmm


def test_all_rounds_run_over_all_documents(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(12) + 12 * (k % 3 == i % 3)}" for k in range(rnd.randrange(5, 40))) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = hmm.word_counts(docs).cache()
    fresh = hmm.vocabulary(counts, own=100)
    seqs = hmm.coded(docs, fresh)
    want = hmm.vocabulary(counts, own=100)
    rng, u = np.random.default_rng(7), want.unigram()
    want.start, want.move = np.full(3, 1 / 3), np.full((3, 3), 0.1) + np.eye(3) * 0.7
    emit = u[:, None] * rng.gamma(2.0, size=(len(u), 3))
    want.emit = emit / emit.sum(0)
    symbols = want.symbols()
    plain = [np.array([symbols[w] for w in [*t.encode().split(), hmm.END]], np.int32) for t in texts]
    was = None
    for _ in range(hmm.ROUNDS):
        starts, moves, emissions, now = hmm.expected(want, plain)
        want = hmm.improved(want, starts, moves, emissions)
        if was is not None and now - was < hmm.TOLERANCE * abs(was):
            break
        was = now
    got = hmm.train(seqs, fresh, states=3)
    assert np.allclose(got.move, want.move, atol=1e-3) and np.allclose(got.emit, want.emit, atol=1e-3)


def test_batches_are_coded_without_a_lookup_a_word(monkeypatch):
    texts = ["The cat sat on the mat", None, "", "x" * 40 + " cat " + "y" * 33, "naïve \x00 cat\x00 日本 日 \n\nthe", "cat"]
    words = [b"the", b"cat", "日本".encode(), b"\x00", hmm.END]
    model = hmm.Model(words, np.ones(len(words), np.int64), np.ones(hmm.CLASSES), 20, 9)
    symbols = model.symbols()
    plain = [[*(t or "").encode().lower().split(), hmm.END] for t in texts]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([ids, ids, ids, pa.array(texts)], ["doc_id", "did", "th", "text"])
    sent = type("Sent", (), {"value": model})
    monkeypatch.setattr(hmm.Model, "symbols", None)  # a Python object and a lookup for each word took half of these steps' time
    (got,) = hmm._coded(sent)(iter([batch]))
    assert [np.frombuffer(x, np.int32).tolist() for x in got.column("s").to_pylist()] == [[symbols[w] for w in p] for p in plain]
    (got,) = hmm._rare(sent)(iter([batch]))
    rare = Counter((i, w) for i, p in enumerate(plain) for w in p if w not in symbols)
    seen = {(i, k): n for i, k, n in zip(*(got.column(c).to_pylist() for c in ("did", "key", "tf")), strict=True)}
    assert {k: n for k, n in seen.items() if not k[1].startswith(hmm.END)} == {k: n for k, n in rare.items() if len(k[1]) <= 32}
    assert sorted(n for k, n in seen.items() if k[1].startswith(hmm.END)) == [1, 1]
