"""Fingerprints, the next row's text and the block tables against plain Python."""

import hashlib
import random
import struct

import numpy as np
import xxhash

from corvine.llm import fingerprints as fp


def _spark_hash(words):
    """Spark's xxhash64 of strings: each value is hashed with the hash so far as seed."""
    h = 42
    for w in words:
        if w is not None:
            h = xxhash.xxh64_intdigest(w.encode(), h)
    return h


def _fingerprint(text):
    words = text.lower().strip(" \t\n\x0b\x0c\r").split()
    pairs = list(zip(words, words[1:], strict=False)) or [(w, None) for w in words]
    votes, total = [0] * 64, 0
    for a, b in pairs:
        w = min(fp.HEAVIEST, len(a) + len(b or ""))
        h, total = _spark_hash((a, b)), total + w
        for k in range(64):
            votes[k] += w * (h >> k & 1)
    return struct.unpack("<q", struct.pack("<Q", sum(1 << k for k in range(64) if votes[k] * 2 > total)))[0]


def _texts():
    rnd = random.Random(3)
    texts = [None, "", " \n", "one", "é à ü", "x y"] + [" ".join(rnd.choice(["a", "bcd", "Éf", "ghi", "jk"]) for _ in range(rnd.randrange(1, 60))) for _ in range(60)]
    return [*texts, texts[-1], "a b c " * 3000]


def test_compared(spark):
    rows = [(i * 7 % 1000, t, "z") for i, t in enumerate(_texts())]
    got = {r.doc_id: r for r in fp.compared(spark.createDataFrame(rows, "doc_id long, text string, at string")).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for (i, t, _), (_, after, _) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fp, r.edited_fp) == (_fingerprint(t), _fingerprint(edited))
        differing = bin((r.fp ^ _fingerprint(after)) & (1 << 64) - 1).count("1")
        assert abs(r.near_next - (1 if not differing else max(0, np.cos(np.pi * differing / 64)))) < 1e-12


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    got = fp.compared(docs).collect()
    assert len(got) == 5 and len({r.fp for r in got}) == 2
    assert fp.compared(docs.limit(0)).collect() == []
    one = fp.compared(docs.where("doc_id is null").limit(1)).collect()
    assert one[0].near_next == 1.0


def test_half_of_the_ids_null(spark):
    texts = [f"some words of text {i} {'x' * (i % 7)}" for i in range(200)]
    docs = spark.createDataFrame([(None if i % 2 else i, t) for i, t in enumerate(texts)] + [(4, texts[4])] * 3, "doc_id long, text string")
    rows, places = fp.with_next(docs)
    places = {(r.did, r.th): (r.next_did, r.next_th) for r in places.collect()}
    order = sorted(places)
    assert len(order) == 200 and all(places[a] == b for a, b in zip(order, order[1:] + order[:1], strict=True))
    assert sorted(r.fp for r in fp.compared(docs).collect()) == sorted(_fingerprint(t) for t in texts + [texts[4]] * 3)


def test_block_tables(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(-(2**63), 2**63, 200)
    near = [int(x) ^ (sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False))) for x in base]
    every = [int(x) for x in base] + near
    df = spark.createDataFrame([(x,) for x in every], "fp long")
    got = {(r.q, r.fp) for r in fp.within(df, df).collect()}
    assert got == {(a, b) for a in every for b in every if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
