"""Substring dedup: words covered by a window of 35 words that also starts elsewhere are found by FM-indexes, one a shard.

Method. What could match meets in one shard. Of the word 10-grams of a window the one with the smallest hash (the first of equal
ones) is its anchor; equal windows have equal anchors. Consecutive windows of a document with one anchor place are a segment, with the
anchor's hash as key. Keys that occur once in the corpus can hold no repeat and go. Equal segments of a key are grouped, with their
number as weight, before anything is gathered, so a passage that a third of all documents hold is one row. The words of one segment of
each group are fetched, segments are dealt by key and streamed in key order into shards of about ``SHARD_WORDS`` words that end
between keys. Over each shard a compressed FM-index (wavelet matrix over the Burrows-Wheeler transform) is built; backward search gives matching
statistics, weighted by the groups' sizes, and windows of full length are reported. From one end to the end before it the statistic falls
by one at most, so one long search from a segment's last end decides every window that lies within its match; the windows
left over are searched one by one. Reports are joined back to the documents that hold the segment, and the words covered are removed.

Texts are cut into segments once; the keys, hashes and spans of a document are kept as packed arrays until the keys are counted.

Counts of keys are map-side combined; joins by key are between freshly dealt sides, so adaptive execution can split a hot key. One key's
*different* segments go to one shard: these are the edges of a passage in different contexts, at most a few for each document that holds it.

Defined cases. A null text has no words. Repeated rows are documents of their own, so each one's windows occur elsewhere. A document of
fewer than 35 words loses none. Null doc_ids are told apart by their texts. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import durable, forget, sliced
from corvine.llm.fm_index import FMIndex

WINDOW, ANCHOR, SHARD_WORDS = 35, 10, 400_000
_FACTOR = 0x9E3779B97F4A7C15
_LEAST = -(1 << 63)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _powers(n: int) -> np.ndarray:
    p = np.full(n, np.uint64(_FACTOR))
    p[:1] = 1
    return np.multiply.accumulate(p)


def segments(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, hash of the segment, first window, windows) of each segment of a document."""
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    m = n - anchor + 1
    g = h[:m].copy()
    for k in range(1, anchor):
        g *= np.uint64(_FACTOR)
        g ^= g >> np.uint64(29)
        g += h[k : m + k]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    place = np.arange(n - window + 1)
    for a in range(0, len(place), 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(g[a : a + (1 << 16) + window - anchor], window - anchor + 1)
        place[a : a + (1 << 16)] += view[: len(place) - a][: 1 << 16].argmin(1)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, len(place)])
    # Hash of the words first to first + count + window - 1: a difference of running sums, moved to a common origin.
    sums = np.r_[np.uint64(0), np.cumsum(h * _powers(n))]
    inverse = pow(_FACTOR, -1, 1 << 64)
    back = np.full(n + 1, np.uint64(inverse))
    back[0] = 1
    back = np.multiply.accumulate(back)
    own = (sums[first + count + window - 1] - sums[first]) * back[first]
    own ^= own >> np.uint64(31)
    own = own * np.uint64(_FACTOR) + count.astype(np.uint64)
    return g[place[first]].view(np.int64), own.view(np.int64), first, count


def _segmented(window: int, anchor: int):
    """keys, owns and spans of each document that has segments, as packed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [segments(words_of(t), window, anchor) for t in batch.column("text").to_pylist()]
            at = pa.array([i for i, x in enumerate(found) if len(x[0])], pa.int64())
            packed = [[x[0].tobytes(), x[1].tobytes(), (x[2] * 64 + x[3]).astype(np.int64).tobytes()] for x in found if len(x[0])]
            columns = [pa.array([x[i] for x in packed], pa.binary()) for i in range(3)]
            yield pa.record_batch([batch.column("did").take(at), batch.column("th").take(at), *columns], ["did", "th", "keys", "owns", "spans"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "keys"):
        yield pa.record_batch([pa.array(np.concatenate([np.frombuffer(x, np.int64) for x in batch.column("keys").to_pylist()]))], ["key"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "keys"):
        key, own, span = ([np.frombuffer(x, np.int64) for x in batch.column(c).to_pylist()] for c in ("keys", "owns", "spans"))
        at = pa.array(np.repeat(np.arange(len(key)), [len(x) for x in key]))
        yield pa.record_batch([pa.array(np.concatenate(key)), pa.array(np.concatenate(own)), batch.column("did").take(at), batch.column("th").take(at), pa.array(np.concatenate(span))], ["key", "own", "did", "th", "span"])


def _cut_out(window: int):
    """The words of each wanted segment of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            keys, owns, ns, segs, counts = [], [], [], [], []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                words = words_of(text)
                for w in wanted:
                    first, count = w["span"] >> 6, w["span"] & 63
                    keys.append(w["key"])
                    owns.append(w["own"])
                    ns.append(w["n"])
                    counts.append(count)
                    segs.append(b" ".join(words[first : first + count + window - 1]))
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(owns, pa.int64()), pa.array(ns, pa.int64()), pa.array(counts, pa.int32()), pa.array(segs, pa.binary())], ["key", "own", "n", "windows", "words"])

    return run


def repeated_windows(segs: list[list[bytes]], weights: np.ndarray, window: int) -> list[int]:
    """For each segment a number whose bit i is 1 if its i-th window occurs twice or more in the shard."""
    ids: dict[bytes, int] = {}
    number = [np.array([ids.setdefault(w, len(ids) + 1) for w in s], np.int64) for s in segs]
    count = np.fromiter((len(s) - window + 1 for s in segs), np.int64, len(segs))
    index = FMIndex(number, weights, len(ids) + 1, int(count.max()) + window)
    whole = index.matching(index.starts + count + window - 1, count + window - 1)
    decided = np.maximum(whole - window + 1, 0)  # so many windows, from the last one on, lie within the match
    bits = ((np.int64(1) << decided) - 1) << (count - decided)
    # The last window itself is decided either way.
    left = np.minimum(count - decided, count - 1)
    owner = np.repeat(np.arange(len(segs)), left)
    i = np.arange(len(owner)) - np.repeat(np.cumsum(left) - left, left)
    full = index.matching(index.starts[owner] + i + window, window) >= window
    np.bitwise_or.at(bits, owner[full], np.int64(1) << i[full])
    return bits.tolist()


def _searched(window: int, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            bits = repeated_windows([x[3] for x in held], np.array([x[2] for x in held], np.int64), window)
            rows = [(k, o, b) for (k, o, _, _), b in zip(held, bits, strict=True) if b]
            key, own, got = list(zip(*rows, strict=True)) or ((), (), ())
            return pa.record_batch([pa.array(key, pa.int64()), pa.array(own, pa.int64()), pa.array(got, pa.int64())], ["key", "own", "bits"])

        for batch in batches:
            for key, own, n, _, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= shard_words and held[-1][0] != key:
                    yield shard()
                    held, size = [], 0
                held.append((key, own, n, words.split(b" ")))
                size += len(held[-1][3])
        if held:
            yield shard()

    return run


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", F.coalesce("doc_id", F.lit(_LEAST)).alias("did"), F.xxhash64("text").alias("th"), "text")


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(did, th, spans): for each document with repeats its segments with bits of repeated windows."""
    if not anchor <= window <= anchor + 57:
        raise ValueError("a segment has 58 windows at most")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _identified(docs)
    packed = durable(rows.select("did", "th", "text").mapInArrow(_segmented(window, anchor), "did long, th long, keys binary, owns binary, spans binary"))
    more = durable(packed.select("keys").mapInArrow(_keys, "key long").groupBy("key").count().where("count > 1").select("key"))
    found = packed.mapInArrow(_unpacked, "key long, own long, did long, th long, span long")
    found = durable(found.join(more.hint("shuffle_hash"), "key", "left_semi"))
    forget(packed)
    forget(more)
    groups = found.groupBy("key", "own").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "th", "span")).alias("at"))
    wanted = groups.groupBy(F.col("at.did").alias("did"), F.col("at.th").alias("th")).agg(F.collect_list(F.struct("key", "own", "n", F.col("at.span").alias("span"))).alias("wanted"))
    texts = rows.select("did", "th", "text").join(wanted.hint("shuffle_hash"), ["did", "th"])
    # Of repeated rows one gives the words.
    cut = texts.mapInArrow(_cut_out(window), "key long, own long, n long, windows int, words binary")
    bits = cut.repartition(parts, "key").sortWithinPartitions("key", "own").mapInArrow(_searched(window, shard_words), "key long, own long, bits long")
    bits = durable(bits.groupBy("key", "own").agg(F.max("bits").alias("bits")))
    return found.join(bits, ["key", "own"]).groupBy("did", "th").agg(F.collect_set(F.struct("span", "bits")).alias("spans"))


def covered(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Which of n words a repeated window covers."""
    edge = np.zeros(n + 1, np.int64)
    for x in spans:
        first, bits = x["span"] >> 6, x["bits"]
        while bits:
            i = (bits & -bits).bit_length() - 1
            edge[first + i] += 1
            edge[first + i + window] -= 1
            bits &= bits - 1
    return np.cumsum(edge[:n]) > 0


def _kept(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            n_words, n_removed, out, runs = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = words_of(text)
                n_words.append(len(words))
                gone = covered(len(words), spans, window) if spans else np.zeros(len(words), bool)
                n_removed.append(int(gone.sum()))
                left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if spans else b" ".join(words)
                out.append(left.decode("utf-8", "surrogatepass") if with_text else hashlib.sha256(left).hexdigest())
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                runs.append([{"first": a, "last": b - 1} for a, b in edge.tolist()])
            arrays = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())]
            if with_text:
                arrays.append(pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))))
            yield pa.record_batch(arrays, ["doc_id", "n_words", "n_removed", "kept" if with_text else "kept_sha256", *["intervals"] * with_text])

    return run


def _joined(docs: DataFrame, window: int, anchor: int, shard_words: int) -> DataFrame:
    return _identified(docs).join(repeats(docs, window, anchor, shard_words).hint("shuffle_hash"), ["did", "th"], "left").select("doc_id", "text", "spans")


def removed(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay) and intervals (first and last word of each stretch removed)."""
    return _joined(docs, window, anchor, shard_words).mapInArrow(_kept(window, True), "doc_id long, n_words long, n_removed long, kept string, intervals array<struct<first: long, last: long>>")


def digests(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the words that stay."""
    return _joined(docs, window, anchor, shard_words).mapInArrow(_kept(window, False), "doc_id long, n_words long, n_removed long, kept_sha256 string")
