"""What Python workers keep between tasks: they are used again by other operators."""

import weakref

import numpy as np
import pyarrow as pa
import pytest

from corvine.llm import bpe, language_id, similarity_join


@pytest.fixture
def built(monkeypatch):
    pytest.importorskip("public_tokenizers")
    out = []

    class Seen(bpe.Codec):
        def __init__(self, raw):
            super().__init__(raw)
            out.append(weakref.ref(self))

    monkeypatch.setattr(bpe, "Codec", Seen)
    return out


def test_a_codec_ends_with_the_next_operators_task(built):
    with open(bpe.tokenizer_path(), "rb") as f:
        sent = type("Sent", (), {"value": f.read()})
    docs = pa.record_batch([pa.array([1, 2]), pa.array(["one two", None]), pa.array(["en", "en"])], ["doc_id", "text", "lang"])
    for _ in range(2):  # two tasks of one operator build one codec
        assert sum(b.num_rows for b in bpe._run(sent, False)(iter([docs]))) == 2
    assert len(built) == 1 and built[0]() is not None
    for other in (similarity_join._shingles, language_id._counted):
        list(other(iter([docs])))
        assert built[-1]() is None
        list(bpe._run(sent, True)(iter([docs])))
    assert len(built) == 3


def test_damped_counts():
    c = np.random.default_rng(1).poisson(1.0, (3, 50)).astype(np.float32)
    before = c.copy()
    assert (language_id.damped(c) == np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0).astype(np.float32)).all()
    assert (c == before).all()


def test_checked_pairs_give_their_ids_alone():
    a, b = np.arange(10), np.arange(100, 110)
    sets = pa.array([x.tobytes() for x in (a, a)], pa.binary()), pa.array([x.tobytes() for x in (a, b)], pa.binary())
    batch = pa.record_batch([pa.array([1, 1]), pa.array([2, 3]), *sets], ["a", "b", "mx", "my"])
    assert [x.to_pylist() for x in similarity_join._verified(iter([batch]))] == [[{"a": 1, "b": 2}]]
