"""Line dedup: hashes of lines are range-partitioned with document and position as secondary sort, runs are streamed,
and each document gets a compressed bitmap of the lines that stay.

Method. Every line whose key is long enough gives one row (128-bit hash, doc_id, hash of the text, line number). The rows are written
once, dealt by range on all of these and sorted, so that even a line held by a third of all documents is
spread over many tasks. A task streams its sorted rows; a run of equal hashes that lies within the task is decided on
the spot. The first and the last run may go on in a neighbouring task: what is known of them (two rows a task at most)
is summed over all tasks and joined back by broadcast, which is bounded by twice the number of partitions. The lines to drop are
gathered into one compressed bitmap a document, and texts are only touched when a bitmap is applied.

Defined cases. A null or empty text is one empty line. Rows with the same doc_id count as one document for the number of
documents holding a line, and all of them keep it if that doc_id is the largest; each row's own lines are decided, as rows are
told apart by doc_id and text. A null doc_id counts as one document below all others. Empty tables give empty results. Columns beside doc_id and text are ignored by the decision and carried by ``apply``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import SPACES, durable, forget, sliced

LEAST_CHARS, LEAST_DOCS = 40, 5
_NULL_ID = -(1 << 63)


def line_key(line: str) -> bytes:
    """A line without ASCII white space at its ends, A-Z lower-cased, as UTF-8."""
    return line.strip(SPACES).encode("utf-8", "surrogatepass").lower()


def _hashes(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            hi, lo, of, at = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                if not text or len(text) < least_chars:
                    continue
                for i, line in enumerate(text.split("\n")):
                    if len(line) < least_chars:
                        continue
                    line = line.strip(SPACES)
                    if len(line) >= least_chars:
                        h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass").lower())
                        hi.append(h >> 64)
                        lo.append(h & 0xFFFFFFFFFFFFFFFF)
                        of.append(row)
                        at.append(i)
            of = pa.array(of, pa.int64())
            yield pa.record_batch(
                [pa.array(np.array(hi, np.uint64).view(np.int64)), pa.array(np.array(lo, np.uint64).view(np.int64)), batch.column("did").take(of), batch.column("th").take(of), pa.array(at, pa.int32())],
                ["hi", "lo", "did", "th", "line"],
            )

    return run


def _streamed(least_docs: int):
    """Runs of equal hashes in sorted rows. kind 0: a line to drop; 1: a line of an edge run; 2: the sum of an edge run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "hi", "lo", "did", "th", "line", "n_docs", "last_doc", "first_doc"]

        def rows(kind, hi, lo, doc, th, line, n=None, last=None, first=None):
            k = len(hi)
            none = pa.nulls(k, pa.int64())
            return pa.record_batch([pa.array(np.full(k, kind, np.int32)), pa.array(hi), pa.array(lo), pa.array(doc), pa.array(th), pa.array(line.astype(np.int32)), none if n is None else pa.array(n), none if last is None else pa.array(last), none if first is None else pa.array(first)], names)

        def judged(hi, lo, doc, th, line, first, final):
            """Whole runs; the first and the last of the task are edges."""
            new = np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]
            start = np.flatnonzero(new)
            stop = np.r_[start[1:], len(hi)]
            run_of = np.cumsum(new) - 1
            fresh = np.r_[True, doc[1:] != doc[:-1]] | new
            n_docs = np.add.reduceat(fresh.astype(np.int64), start)
            last = doc[stop - 1]
            edge = np.zeros(len(start), bool)
            edge[0], edge[-1] = first, final or (first and len(start) == 1)
            drop = (~edge & (n_docs >= least_docs))[run_of] & (doc != last[run_of])
            yield rows(0, hi[drop], lo[drop], doc[drop], th[drop], line[drop])
            open_ = edge[run_of]
            yield rows(1, hi[open_], lo[open_], doc[open_], th[open_], line[open_])
            e = np.flatnonzero(edge)
            yield rows(2, hi[start[e]], lo[start[e]], last[e], th[start[e]], np.zeros(len(e)), n_docs[e], last[e], doc[start[e]])

        held: list[tuple[np.ndarray, ...]] = []  # pieces of the run that the rows so far end in
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            piece = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            hi, lo = piece[:2]
            same = (hi == hi[-1]) & (lo == lo[-1])
            tail = len(hi) - int(same.sum())
            if held and tail == 0 and (held[-1][0][-1], held[-1][1][-1]) == (hi[-1], lo[-1]):
                held.append(piece)
                continue
            if tail or held:
                whole = [np.concatenate(x) for x in zip(*held, tuple(x[:tail] for x in piece), strict=True)]
                yield from judged(*whole, first, False)
                first = False
            held = [tuple(x[tail:] for x in piece)]
        if held:
            yield from judged(*(np.concatenate(x) for x in zip(*held, strict=True)), first, True)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for gone in batch.column("gone").to_pylist():
            keep = np.ones(max(gone) // 8 * 8 + 8, bool)
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6))
        yield pa.record_batch([batch.column("did"), batch.column("th"), pa.array(maps, pa.binary())], ["did", "th", "keep_bitmap"])


def kept_lines(lines: list[str], bitmap: bytes | None) -> list[str]:
    """The lines that a bitmap of ``keep_bitmaps`` keeps; without one all stay."""
    if bitmap is None:
        return lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little").tolist()
    return [x for x, k in zip(lines, keep, strict=False) if k] + lines[len(keep) :]


def _identified(docs: DataFrame) -> list[Column]:
    """did and th, which tell rows apart: doc_id (a null below all others) and a hash of the text."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(_NULL_ID)).alias("did"), F.xxhash64(docs["text"].cast("string")).alias("th")]


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(did, th, line): the lines to drop, one row each."""
    spark = docs.sparkSession
    rows = docs.select(*_identified(docs), F.col("text").cast("string").alias("text"))
    hashes = durable(rows.mapInArrow(_hashes(least_chars), "hi long, lo long, did long, th long, line int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["hi", "lo", "did", "th", "line"]
    kinds = "kind int, hi long, lo long, did long, th long, line int, n_docs long, last_doc long, first_doc long"
    runs = durable(hashes.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(_streamed(least_docs), kinds))
    forget(hashes)
    # Pieces of one run: a document cut in two by a boundary is the last of one piece and the first of another.
    pieces = runs.where("kind = 2")
    whole = pieces.groupBy("hi", "lo").agg(
        F.sum("n_docs").alias("n"), F.max("last_doc").alias("keep"),
        F.array_sort(F.collect_list(F.struct("first_doc", "last_doc"))).alias("p"),
    )
    shared = F.expr("aggregate(sequence(1, size(p) - 1), 0L, (a, i) -> a + if(p[i].first_doc = p[i - 1].last_doc, 1L, 0L))")
    whole = whole.withColumn("n_docs", F.col("n") - F.when(F.size("p") > 1, shared).otherwise(F.lit(0)))
    whole = whole.where(F.col("n_docs") >= least_docs).select("hi", "lo", "keep")
    edges = runs.where("kind = 1").join(F.broadcast(whole), ["hi", "lo"]).where("did <> keep")
    return runs.where("kind = 0").select("did", "th", "line").unionByName(edges.select("did", "th", "line"))


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """did, th (as of ``_identified``), keep_bitmap for each document that loses a line; the others keep all.

    keep_bitmap: zlib; bit i, little end first: line i stays. Lines behind the last bit stay.
    """
    gone = dropped_lines(docs, least_chars, least_docs).groupBy("did", "th").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    return gone.mapInArrow(_bitmaps, "did long, th long, keep_bitmap binary")


def with_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The columns doc_id and text of documents with keep_bitmap (null: all lines stay)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *_identified(docs))
    return rows.join(keep_bitmaps(docs, least_chars, least_docs).hint("shuffle_hash"), ["did", "th"], "left").select("doc_id", "text", "keep_bitmap")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        n_lines, n_dropped, digest = [], [], []
        for text, bitmap in zip(batch.column("text").to_pylist(), batch.column("keep_bitmap").to_pylist(), strict=True):
            text = text or ""
            lines = text.split("\n")
            kept = kept_lines(lines, bitmap)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            digest.append(hashlib.sha256((text if bitmap is None else "\n".join(kept)).encode("utf-8", "surrogatepass")).hexdigest())
        yield pa.record_batch([batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def digests(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    return with_bitmaps(docs, least_chars, least_docs).mapInArrow(_digested, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def apply(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents with their columns, text being what stays and n_chars, if there, its length."""
    maps = keep_bitmaps(docs, least_chars, least_docs).toDF("_did", "_th", "_keep")
    did, th = _identified(docs)
    names = docs.columns
    at = names.index("text")
    rows = docs.select("*", did.alias("_did"), th.alias("_th")).join(maps.hint("shuffle_hash"), ["_did", "_th"], "left").select(*names, "_keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            texts = batch.column(at)
            maps = batch.column(len(names)).to_pylist()
            if any(m is not None for m in maps):
                texts = [t if m is None else "\n".join(kept_lines((t or "").split("\n"), m)) for t, m in zip(texts.to_pylist(), maps, strict=True)]
                texts = pa.array(texts, batch.schema.field(at).type)
            yield pa.record_batch([texts if i == at else batch.column(i) for i in range(len(names))], names)

    out = rows.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
