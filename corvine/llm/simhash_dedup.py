"""SimHash near-dedup with Golay-code fuzzy hashing: every pair of fingerprints at 3 or fewer differing bits is linked.

Method. A 64-bit fingerprint is cut into segments A (23 bits), B (23) and C (18, two halves of 9). The perfect Golay code
[23, 12, 7] decodes any 23-bit word to one of 4096 codeword indices. A word and its one-bit neighbours decode to at most six
indices; two words at distance 1 share the decoded index of either with the six of the other. By the pigeonhole principle 3
errors over three segments leave one of these cases, and each is an exact-match key:

* two segments free of errors: both as they are;
* one free of errors, one with one error: the first as it is, a Golay index of the second;
* one error in each: Golay indices of A and B, and the half of C without the error as it is.

Where a segment holds exactly one error its parity differs, so words of odd parity give the one decoded index and words of
even parity give all six: each pair meets, and half of the keys are saved. About 50 rows a distinct fingerprint come out, with
keys of 35 bits at least. Rows are dealt by key, streamed in key order, and every meeting is verified by the exact distance.
Inside a run of equal keys a breadth-first search returns a spanning forest of the links, not all pairs.

Equal fingerprints are grouped first, so copies, however many, are one row from there on. Components are found by star
contraction over fingerprints; a component's smallest doc_id is found afterwards.

Defined cases. A null or wordless text has fingerprint zero and is linked like any other. Null doc_ids count as larger than all
others; a group without any other has a null component_id. Repeated rows are members like any other; rows that share a doc_id, but
not a text, are linked by their fingerprints alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvine.llm import components
from corvine.llm.common import durable, sliced

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Runs up to this size are searched without blocks.
SHORT = 512
#: Fixed value: the generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
_SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    stops = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 16384):
        cut = zip(starts[at : min(n, at + 16384)].tolist(), stops[at : at + 16384].tolist(), strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in cut], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def folded(hashes: np.ndarray) -> int:
    """The fingerprint of a text by the hashes (uint64, repeats included) of all its shingles."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        votes += np.unpackbits(hashes[at : at + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            fps = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("th"), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): fp is the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, th long, fp long")


_TABLE: list[np.ndarray] = []


def golay_index() -> np.ndarray:
    """The 12-bit codeword index that each 23-bit word decodes to. Built by rule once a process: 16 MB."""
    if not _TABLE:
        def remainder(x: np.ndarray) -> np.ndarray:
            x = x.copy()
            for bit in range(22, 10, -1):
                x ^= np.where(x >> bit & 1, GOLAY << (bit - 11), 0).astype(np.int32)
            return x

        ones = [1 << i for i in range(23)]
        errors = [0, *ones, *(a | b for a in ones for b in ones if a < b), *(a | b | c for a in ones for b in ones if a < b for c in ones if b < c)]
        fix = np.zeros(2048, np.int32)
        patterns = np.array(errors, np.int32)
        fix[remainder(patterns)] = patterns
        table = np.empty(1 << 23, np.uint16)
        for at in range(0, len(table), 1 << 17):  # in pieces, as whole arrays on the way would take 200 MB in each worker
            words = np.arange(at, at + (1 << 17), dtype=np.int32)
            table[at : at + len(words)] = (words ^ fix[remainder(words)]) >> 11
        _TABLE.append(table)
    return _TABLE[0]


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """(n, 6) codeword indices of each word and its one-bit neighbours within ``bits``; -1 where there are fewer."""
    flips = np.array([0, *(1 << i for i in range(bits))], np.int64)
    found = np.sort(golay_index()[words[:, None] ^ flips].astype(np.int32), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    out = np.full((len(words), 6), -1, np.int32)
    row, col = np.nonzero(fresh)
    out[row, (np.cumsum(fresh, axis=1) - 1)[row, col]] = found[row, col]
    return out


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, position in fps, side): side 0 meets all of its key, 1 meets 2 only."""
    seg = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _SEGMENTS]
    odd = [np.bitwise_count(s) % 2 == 1 for s in seg]
    one = [golay_index()[s].astype(np.int64) for s in seg]
    six = [near_indices(s, n) for s, (_, n) in zip(seg, _SEGMENTS, strict=True)]
    rows = np.arange(len(fps))
    keys, who, side = [], [], []

    def put(tag: int, key: np.ndarray, at: np.ndarray, kind: int) -> None:
        keys.append(np.int64(tag << 48) | key)
        who.append(at)
        side.append(np.full(len(at), kind, np.int8))

    tag = 0
    for x, y in ((0, 1), (0, 2), (1, 2)):
        tag += 1
        put(tag, seg[x] << 23 | seg[y], rows, 0)
    for x in range(3):
        for y in range(3):
            if x != y:
                tag += 1
                i = rows[odd[y]]
                put(tag, seg[x][i] << 12 | one[y][i], i, 1)
                i, k = np.nonzero((six[y] >= 0) & ~odd[y][:, None])
                put(tag, seg[x][i] << 12 | six[y][i, k], i, 2)
    for half in range(2):  # the half of C that has no error; B and the other half have one each
        tag += 1
        exact = seg[2] >> (9 * half) & 511
        i = rows[odd[0]]
        put(tag, (exact[i] << 24 | one[0][i] << 12 | one[1][i]) << 1 | odd[1][i], i, 1)
        i = rows[~odd[0]]
        both = (six[0][i][:, :, None] >= 0) & (six[1][i][:, None, :] >= 0)
        r, a, b = np.nonzero(both)
        i = i[r]
        put(tag, (exact[i] << 24 | six[0][i, a].astype(np.int64) << 12 | six[1][i, b]) << 1 | ~odd[1][i], i, 2)
    return np.concatenate(keys), np.concatenate(who), np.concatenate(side)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), 4096):
            part = fps[at : at + 4096]
            key, who, side = keys_of(part)
            yield pa.record_batch([pa.array(key), pa.array(part[who].view(np.int64)), pa.array(side)], ["key", "fp", "side"])


def forest(fps: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a run as a spanning forest. Sides 1 and 2 meet each other; side 0 meets all.

    Short runs are searched breadth first. In a long one members are dealt by 4 blocks of 16 bits first: members within 3 bits agree in
    one block at least, so only those that share a block are compared, and a run whose members don't link costs no square.
    """
    if len(fps) <= SHORT:
        return _spanning(fps, side, radius, np.arange(len(fps)))
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    out = []
    for block in fps.view(np.uint16).reshape(-1, 4).T:
        by = np.argsort(block, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
            if len(part) > 1:
                for u, v in _spanning(fps, side, radius, part):
                    a, b = find(u), find(v)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((u, v))
    return out


def _spanning(fps: np.ndarray, side: np.ndarray, radius: int, left: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            u = todo.pop()
            hit = np.bitwise_count(fps[left] ^ fps[u]) <= radius
            if side[u]:
                hit &= side[left] != side[u]
            if hit.any():
                found = left[hit]
                out += [(int(u), int(v)) for v in found]
                todo += found.tolist()
                left = left[~hit]
    return out


def _linked(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def judged(key: np.ndarray, fp: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            two = start[size == 2]
            a, b = fp[two], fp[two + 1]
            ok = (np.bitwise_count(a ^ b) <= radius) & ((side[two] == 0) | (side[two] != side[two + 1]))
            out_a, out_b = [a[ok]], [b[ok]]
            for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                own = fp[s : s + n]
                if pairs := forest(own, side[s : s + n], radius):
                    i, j = np.array(pairs).T
                    out_a.append(own[i])
                    out_b.append(own[j])
            x, y = np.concatenate(out_a).view(np.int64), np.concatenate(out_b).view(np.int64)
            keep = x != y
            pair = np.unique(np.stack([np.minimum(x, y)[keep], np.maximum(x, y)[keep]], 1), axis=0)
            if len(pair):
                yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            piece = (batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False))
            tail = int(np.searchsorted(piece[0], piece[0][-1], "left"))
            if held and tail == 0 and held[0][0][0] == piece[0][0]:
                held.append(piece)
                continue
            yield from judged(*(np.concatenate(x) for x in zip(*held, tuple(x[:tail] for x in piece), strict=True)))
            held = [tuple(x[tail:] for x in piece)]
        if held:
            yield from judged(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(x, y) links between distinct fingerprints (column fp) that give the same components as all pairs within the radius."""
    if radius > 3:
        raise ValueError("the keys guarantee pairs at 3 or fewer differing bits")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("fp").mapInArrow(_keyed, "key long, fp long, side byte")
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_linked(radius), "x long, y long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, th (hash of the text), fp (signed long), gid (the group's smallest fp), component_id for every row of docs."""
    rows = durable(fingerprints(docs, shingle))
    nodes = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    named = components.named(nodes.withColumnRenamed("fp", "node"), links(nodes, radius).toDF("a", "b")).withColumnRenamed("node", "fp")
    return rows.join(named, "fp").select("doc_id", "th", "fp", "gid", "component_id")


def hex_digits(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group stays: see ``without_copies``."""
    return without_copies(docs, near_duplicates(docs.select("doc_id", "text"), shingle, radius))


def without_copies(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs less the rows that ``found`` (doc_id, th, gid; a row for each of docs) shows to be copies.

    Of each group gid the row with the smallest doc_id stays; of a group's rows with that doc_id the text with the smallest hash stays,
    and of rows equal in doc_id and text one. Groups that share a doc_id don't touch each other. Rows without a doc_id stay.
    """
    did = F.col("doc_id").cast("long")
    found = found.where("doc_id is not null")
    kept = found.groupBy("gid").agg(F.min(F.struct(did.alias("did"), F.col("th").alias("th"))).alias("k")).select(F.col("k.did").alias("_did"), F.col("k.th").alias("_th"))
    # Only rows that occur again are grouped; all others pass without a sort.
    counts = found.groupBy(did.alias("_did"), F.col("th").alias("_th")).agg((F.count(F.lit(1)) > 1).alias("_again"))
    kept = durable(kept.join(counts, ["_did", "_th"]))
    rows = docs.where("doc_id is not null").withColumns({"_did": did, "_th": text_hash(F.col("text"))}).join(kept.hint("shuffle_hash"), ["_did", "_th"])
    once = rows.where("not _again").select(*docs.columns).unionByName(docs.where("doc_id is null"))
    return once.unionByName(rows.where("_again").dropDuplicates(["_did", "_th"]).select(*docs.columns))


def text_hash(text: Column) -> Column:
    """With doc_id it tells rows apart."""
    return F.xxhash64(text.cast("string"))
