"""BPE against the tokenizers library."""

import random

import numpy as np
import pytest

from corvine.llm.bpe import LONG, Codec, digests, encoded, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    with open(tokenizer_path(), "rb") as f:
        return Codec(f.read()), tokenizers.Tokenizer.from_file(tokenizer_path())


def _texts():
    rnd = random.Random(1)
    spans = [(32, 127), (0, 0x500), (0x2000, 0x3000), (0x3000, 0xD7FF), (0xE000, 0x1FFFF)]
    out = ["", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|> ' s", "<| endoftext|>", "ΑΣ ΟΔΟΣ ΣΣ", "İstanbul \x1c\x1d x　y\x85z", "it's we'll I'D 12 ½²", "é ﬁ Å é"]
    out += ["a" * (LONG + 100) + " " + "ab" * 500, "thethe" * 300, "x" * LONG]
    return out + ["".join(chr(rnd.choice([rnd.randrange(*s) for s in spans])) for _ in range(rnd.randrange(60))) for _ in range(2000)]


def test_same_ids_and_text(both):
    codec, known = both
    texts = _texts()
    for text, want in zip(texts, known.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, repr(text)
        assert codec.decode(ids) == known.decode(want.ids, skip_special_tokens=False)


def test_every_code_point(both):
    codec, known = both
    texts = [f"a{chr(i)}a" for i in range(0x110000) if not 0xD800 <= i < 0xE000 and (i < 0x3400 or i > 0xA000 and i % 7 == 0)]
    for text, want in zip(texts, known.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == want.ids, repr(text)


def test_frames(spark, both):
    codec, _ = both
    rows = [(1, "Hello there", "x"), (2, None, "y"), (3, "", None), (None, "Hello there", "z"), (1, "Hello there", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, tuple(r.ids)) for r in encoded(docs).collect()}
    ids = tuple(np.frombuffer(codec.encode("Hello there"), "<u4").tolist())
    assert got == {(1, len(ids), ids), (2, 0, ()), (3, 0, ()), (None, len(ids), ids)}
    assert digests(docs).count() == 5
    assert digests(docs.limit(0)).collect() == []
