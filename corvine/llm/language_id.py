"""Language ID by nearest centroid: normalised TF-IDF vectors of character n-grams against several clustered centroids a
language, by cosine, with rejection by distance.

Method. A text is lower-cased, everything but letters becomes a space, and the UTF-8 n-grams of 1 to 4 bytes are hashed into
``DIMS`` columns; counts are damped by 1 + ln, weighted by IDF and scaled to length one. Words with a digit in them count only where
there is nothing else. Of the labelled rows a bounded sample trains: about ``SAMPLE`` rows a label (fewer, 20 at least, where all
labels together would pass ``SAMPLE_ALL``), whole texts chosen by their hash; equal texts of a label are one row of the sample, so however
many copies there are, and whatever the doc_ids, no more reach the driver. Each label's vectors are clustered by spherical k-means into up to ``CLUSTERS`` centroids. A text takes the label
of the centroid with the largest cosine. The score is the share of that label in a softmax over the labels' best cosines. A
text is rejected if its cosine is below a label's threshold: the smallest cosine of the label's own training vectors, less a
margin; short texts have small cosines by nature, so the threshold falls with the square root of the number of n-grams.

Labels, and with them the centroids sent to the executors, are at most ``MOST_LABELS``; more is an error, not a silent cut.

Defined cases. A null text, or one without a letter, is ``und`` with score 0 and rejected. Without any labelled row every text
is. Labels may be any strings; null labels don't train. Repeated rows train once and are predicted like others. Ties go to the
label that sorts first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import sliced

DIMS, ORDERS, CLUSTERS, SAMPLE, SAMPLE_ALL, MOST_LABELS, ROUNDS = 1 << 14, 4, 4, 500, 20_000, 1000, 12
SHARPNESS, MARGIN = 24.0, 0.5
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_WITH_DIGITS = re.compile(r"[^\W\d_]*\d\w*")


def letters(text: str | None) -> bytes:
    """Runs of letters in lower case, a space before, between and after; b"" if there are none."""
    low = (text or "").lower()
    for x in (_WITH_DIGITS.sub(" ", low), low):
        inner = _NOT_LETTERS.sub(" ", x).strip(" ")
        if any(map(str.isalpha, inner)):
            return f" {inner} ".encode("utf-8", "surrogatepass")
    return b""


def counts(raw: bytes, dims: int = DIMS) -> np.ndarray:
    """Counts of hashed n-grams."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    out = np.zeros(dims, np.float32)
    code = np.zeros(len(b), np.uint32)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    for n in range(1, ORDERS + 1):
        if len(b) < n:
            break
        code = code[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :] + np.uint32(1)
        out += np.bincount((code * np.uint32(2654435769)) >> shift, minlength=dims).astype(np.float32)
    return out


def damped(c: np.ndarray) -> np.ndarray:
    out = np.maximum(c, 1).astype(np.float32, copy=False)
    np.log(out, out=out)
    out += 1
    out *= c > 0
    return out


@dataclass
class Model:
    labels: list[str] = field(default_factory=list)
    idf: np.ndarray | None = None
    centroids: np.ndarray | None = None  # (k, dims), unit length
    label_of: np.ndarray | None = None  # centroid -> label
    least: np.ndarray | None = None  # label -> smallest accepted cosine of a long text

    def vectors(self, raws: list[bytes]) -> np.ndarray:
        v = damped(np.stack([counts(r) for r in raws]))
        v *= self.idf
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        return v

    def cosines(self, v: np.ndarray) -> np.ndarray:
        """Best cosine for each label."""
        c = v @ self.centroids.T
        return np.stack([c[:, self.label_of == i].max(1) for i in range(len(self.labels))], 1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        raws = [letters(t) for t in texts]
        at = [i for i, r in enumerate(raws) if r and self.labels]
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        for k in range(0, len(at), 64):  # 4 MB an array
            part = at[k : k + 64]
            cos = self.cosines(self.vectors([raws[i] for i in part]))
            best = cos.argmax(1)
            share = np.exp(SHARPNESS * (cos - cos.max(1, keepdims=True)))
            share /= share.sum(1, keepdims=True)
            for i, b, c, s in zip(part, best.tolist(), cos.max(1).tolist(), share.max(1).tolist(), strict=True):
                few = min(1.0, len(raws[i]) / 400) ** 0.5
                out[i] = (self.labels[b], float(min(1.0, max(0.0, s))), c < self.least[b] * few)
        return out


def _spread(v: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; seeds are chosen farthest first, so equal input gives equal centroids."""
    mean = v.mean(0)
    seeds = [int((v @ mean).argmax())]
    near = v @ v[seeds[0]]
    while len(seeds) < min(k, len(v)) and near.min() < 0.999:
        seeds.append(int(near.argmin()))
        near = np.maximum(near, v @ v[seeds[-1]])
    c = v[seeds]
    for _ in range(rounds):
        own = (v @ c.T).argmax(1)
        c = np.stack([v[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Train on (text, lang): about ``sample`` different texts a label reach the driver."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("text", F.lit("language")).alias("_h"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LABELS + 1).collect()}
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"over {MOST_LABELS} labels")
    if not sizes:
        return Model()
    # Of each label the share of hash values that holds about ``sample`` rows: no sort, and nothing is dealt by label.
    sample = min(sample, max(20, SAMPLE_ALL // len(sizes)))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample / n)))])
    picked = rows.where(F.pmod("_h", F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.try_element_at(share, F.col("lang")))
    by_label: dict[str, list[bytes]] = {}
    for lang, raw in picked.dropDuplicates(["lang", "_h"]).select("lang", "text").mapInArrow(_counted, "lang string, counts binary").collect():
        by_label.setdefault(lang, []).append(bytes(raw))
    for own in by_label.values():
        own.sort()
    labels = sorted(by_label)
    if not labels:
        return Model()

    def dense(x: str) -> np.ndarray:
        return np.stack([np.frombuffer(zlib.decompress(r), np.float16) for r in by_label[x]]).astype(np.float32)

    total, having = 0, np.zeros(DIMS)
    for x in labels:
        total += len(by_label[x])
        having += (dense(x) > 0).sum(0)
    idf = (np.log((1 + total) / (1 + having)) + 1).astype(np.float32)
    model = Model(labels, idf)
    cents, owner, least = [], [], []
    for i, x in enumerate(labels):
        v = dense(x) * idf
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        c = _spread(v, clusters, ROUNDS)
        cents.append(c)
        owner += [i] * len(c)
        least.append(float((v @ c.T).max(1).min()) * MARGIN)
    model.centroids, model.label_of, model.least = np.concatenate(cents), np.array(owner), np.array(least, np.float32)
    return model


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        langs, raws = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if raw := letters(text):
                langs.append(lang)
                raws.append(zlib.compress(damped(counts(raw)).astype(np.float16).tobytes(), 1))
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(raws, pa.binary())], ["lang", "counts"])


def _predicting(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in sliced(batches, "text"):
            got = model.predict(batch.column("text").to_pylist())
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            lang, score, rejected = zip(*got, strict=True)
            yield pa.record_batch([*rest, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*names, "lang_pred", "score", "rejected"])

    return run


def held_out(part: int = 2, parts: int = 4):
    """True for documents whose crc32 of doc_id, as text, leaves ``part`` modulo ``parts``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_predicting(sent), "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that aren't rejected, with their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            keep = [not r for _, _, r in sent.value.predict(batch.column("text").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
