"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

Method. Words are runs of letters and digits in lower case (ASCII signs and white space part them); shingles are five words
(an item with fewer words is one shingle). A window has as many words as a benchmark item. A window that shares no shingle
with an item has similarity zero, so only windows over places where a shingle of some item stands are fingerprinted, and of
the item sizes only those of items with such a shingle: nothing that could pass is left out. A window's 64-bit SimHash comes from
running sums of its shingles' signed bits. It is compared with the fingerprints of the items of its size that have one of the document's
shingles (an index of sorted shingles names them), by 8 blocks of a byte: an item stays if some block differs by 2 bits at most, which by the
pigeonhole principle holds for every item within 23 bits, and if all blocks together differ by 23 at most. Each such pair is then verified by
the exact similarity, the weighted Jaccard of shingle counts, sum of minima over sum of maxima.

23 bits is four standard deviations beyond what 0.8 gives by expectation (about 10 of 64), and unrelated texts differ by 32.

The benchmark reaches the executors in blocks of at most ``BLOCK_BYTES`` of text, there about ten times as large in arrays; a larger one takes
a pass a block.

Defined cases. Null, empty and wordless documents or items match nothing. A document shorter than an item is one window. Items
with equal word sequences are one class: item_id is its smallest id (null if there is none), n_items its size. Repeated
documents give a row each. A null doc_id is returned as it is.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import sliced

SHINGLE, THRESHOLD, BYTES, EACH = 5, 0.8, 8, 2
RADIUS = BYTES * (EACH + 1) - 1
BLOCK_BYTES = 16 << 20
_TABLE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    g = h[:n].copy()
    for k in range(1, size):
        g *= _FACTOR
        g ^= g >> np.uint64(29)
        g += h[k : n + k]
    return g


def _signs(g: np.ndarray) -> np.ndarray:
    """(n, 64) of +1 and -1: the signed bits of well-mixed hashes."""
    x = (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _packed(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of shingle counts."""
    common = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


class Items:
    """The items of a block: shingles, fingerprints, and by shingle size the sorted shingles with the items that have them."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        classes: dict[tuple[bytes, ...], list[int | None]] = {}
        for item, text in rows:
            if words := words_of(text):
                classes.setdefault(tuple(words), []).append(item)
        ordered = sorted(classes.items())
        self.ids = [min((x for x in items if x is not None), default=None) for _, items in ordered]
        self.members = [len(items) for _, items in ordered]
        self.n = np.array([len(words) for words, _ in ordered], np.int64)
        grams = [shingles(list(words), min(SHINGLE, len(words))) for words, _ in ordered]
        del classes, ordered
        self.prints = np.array([_packed(_signs(g).sum(0, keepdims=True))[0] for g in grams], np.uint64)
        self.at = np.r_[0, np.cumsum([len(g) for g in grams], dtype=np.int64)]
        self.grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), np.diff(self.at))
        #: shingle size -> sorted shingles, the item of each, and a sieve of their first 20 bits
        self.known = {}
        for s in np.unique(np.minimum(self.n, SHINGLE)).tolist():
            own = np.minimum(self.n, SHINGLE)[owner] == s
            g, i = self.grams[own], owner[own]
            by = np.lexsort((i, g))
            sieve = np.zeros(1 << 20, bool)
            sieve[(g >> np.uint64(44)).astype(np.int64)] = True
            self.known[s] = g[by], i[by], sieve

    def counts(self, i: int) -> Counter:
        return Counter(self.grams[self.at[i] : self.at[i + 1]].tolist())

    def matches(self, text: str | None, threshold: float) -> dict[int, tuple[float, int, int, int]]:
        """Item class -> (similarity, first word, words, differing bits) of its best window, the first of equal ones."""
        words, best = words_of(text), {}
        for s, (known, item, sieve) in self.known.items():
            g = shingles(words, s)
            at = np.flatnonzero(sieve[(g >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(known, g[at], "left"), np.searchsorted(known, g[at], "right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            if not len(at):
                continue
            # Which items share a shingle with the document, and for each item size the places of these shingles.
            runs, which = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
            shared = [np.unique(item[a:b]) for a, b in runs.T.tolist()]
            items = np.unique(np.concatenate(shared))
            sizes = [set(self.n[x].tolist()) for x in shared]
            for n in np.unique(self.n[items]).tolist():
                here = at[np.array([n in x for x in sizes])[which.ravel()]]
                most = max(0, len(words) - n)
                first, last = np.minimum(np.maximum(here + s - n, 0), most), np.minimum(here, most)
                edge = np.zeros(most + 2, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, last + 1, -1)
                starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                self._windows(g, s, n, starts, items[self.n[items] == n], len(words), threshold, best)
        return best

    def _windows(self, g, s, n, starts, items, n_words, threshold, best) -> None:
        m = min(n, n_words) - s + 1  # shingles of a window
        own = {}
        for k in range(0, len(starts), 512):  # windows that lie close are summed together
            part = starts[k : k + 512]
            for run in np.split(part, np.flatnonzero(np.diff(part) > 4 * n) + 1):
                low = int(run[0])
                sums = np.zeros((int(run[-1]) - low + m + 1, 64), np.int32)
                np.cumsum(_signs(g[low : int(run[-1]) + m]), axis=0, out=sums[1:])
                prints = _packed(sums[run - low + m] - sums[run - low])
                for c in range(0, len(items), 4096):
                    some = items[c : c + 4096]
                    blocks = np.bitwise_count((prints[:, None] ^ self.prints[some][None]).view(np.uint8).reshape(len(run), len(some), BYTES))
                    bits = blocks.sum(2, dtype=np.int64)
                    for w, i in zip(*np.nonzero((blocks.min(2) <= EACH) & (bits <= RADIUS)), strict=True):
                        one, start = int(some[i]), int(run[w])
                        if one not in own:
                            own[one] = self.counts(one)
                        like = similarity(Counter(g[start : start + m].tolist()), own[one])
                        if like >= threshold and like > best.get(one, (0.0,))[0]:
                            best[one] = (like, start, min(n, n_words), int(bits[w, i]))


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text") + 16).alias("s")).first()["s"] or 0
    n = math.ceil(size / BLOCK_BYTES)
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()]


def _found(sent, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value)
        for batch in sliced(batches, "text"):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for i, (like, start, n, bits) in sorted(items.matches(text, threshold).items()):
                    out.append((doc, items.ids[i], items.members[i], like, start, n, bits))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "n_items", "similarity", "first_word", "n_words", "differing_bits"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and item class with a window at or above the threshold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_items long, similarity double, first_word long, n_words long, differing_bits int"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        out = out.unionByName(rows.mapInArrow(_found(sent, threshold), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without a match, with their columns."""
    for block in _blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value)
            for batch in sliced(batches, "text"):
                keep = [not items.matches(t, threshold) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
