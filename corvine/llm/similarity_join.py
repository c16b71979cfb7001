"""Near-dedup by SimHash and an exact similarity join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked.

Method. Words are those of SimHash (lower-cased, apart by ASCII white space); a text of one to four words is one shingle. Shingles are 64-bit
hashes, and from the same hashes comes the text's SimHash. Fingerprints at 3 or fewer differing bits meet by their Golay keys
(``simhash_dedup.links``), sets of one fingerprint meet its smallest; what meets is verified on the whole sets, so that a near fingerprint
alone links nothing. The components of these links are the first ones.

Fingerprints guarantee nothing at 0.8, most such pairs are more than 3 bits apart, so a join goes on from there: it tries only pairs of
sets in different components. Two sets at 0.8 or more share one of the first n - ceil(0.8 n) + 1 shingles of each, in any order that is the same for all
sets (prefix filter). The order is by hash, with shingles that many documents hold last, so that keys are rare ones; which ones are last comes
from a sixteenth of the documents, chosen by hash, and moves work, never results. Rows (shingle, set) are dealt by shingle and streamed;
pairs pass the length and the positional filter, then a bound by what their prefixes share, and are verified on the whole sets.

A run of a key with more than ``SMALL`` sets, as a large group of near copies makes, first gives each set with its leader only, the set that has the
key nearest to its start and so passes the filters with the most others. Once these pairs are verified and their components known, the sets outside the leader's
component are paired with leaders of their own, ``ROUNDS`` times; then the run gives all pairs of sets in different components.
Pairs inside a component change nothing, so components are those of all pairs, and a group of near copies isn't squared.

Defined cases. Equal sets are grouped first and are one row from there on; null and wordless texts are equal to each other. Null doc_ids count as
larger than all others; a group without any other has a null component_id. Equal hashes of different shingles or sets are taken for equal (64 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm import components, simhash_dedup
from corvine.llm.common import durable, forget, sliced
from corvine.llm.simhash_dedup import text_hash, without_copies

SHINGLE, SEED = 5, 42
#: Similarity of 0.8 as a fraction.
UP, DOWN = 4, 5
#: Runs up to this size give all pairs at once.
SMALL = 64
#: How often sets that their run's leader isn't linked to are given another before all pairs are tried.
ROUNDS = 3
#: At most so many shingles are put last; they are held by OFTEN documents or more of one in SAMPLED.
LAST, OFTEN, SAMPLED = 1 << 17, 4, 16
#: Up to so many links one task finds the components.
FEW = 1 << 18


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes (unsigned) of a whole text's shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:n]
    stops = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_intdigest
    parts = []
    for at in range(0, n, 16384):
        cut = zip(starts[at : at + 16384].tolist(), stops[at : at + 16384].tolist(), strict=True)
        parts.append(np.array([digest(joined[a:b], SEED) for a, b in cut], np.uint64))
    return np.concatenate(parts)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles, as signed longs."""
    return np.unique(shingles(text).view(np.int64))


def alike(nx, ny, common):
    """Whether sets of nx and ny that share ``common`` are at 0.8 or more; for numbers and arrays."""
    return (UP + DOWN) * common >= UP * (nx + ny)


def set_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64))


def _heads(last):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = last.value
        by = np.argsort(often)
        known = often[by]
        for batch in sliced(batches, "text"):
            prints, ids, sizes, heads = [], [], [], []
            for text in batch.column("text").to_pylist():
                h = shingles(text)
                prints.append(simhash_dedup.folded(h))
                s = np.unique(h.view(np.int64))
                ids.append(set_id(s))
                sizes.append(len(s))
                rank = np.zeros(len(s), np.int64)
                if len(known) and len(s):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, by[at] + 1, 0)
                    s = s[np.argsort(rank, kind="stable")]
                heads.append(s[: len(s) - -(-UP * len(s) // DOWN) + 1].tobytes())
            fps = np.array(prints, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("th"), pa.array(fps), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(heads, pa.binary())], ["doc_id", "th", "fp", "set_id", "n", "head"])

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        for text in batch.column("text").to_pylist():
            yield pa.record_batch([pa.array(shingle_set(text))], ["key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 1 << 20):
        sets = [shingle_set(text) for text in batch.column("text").to_pylist()]
        yield pa.record_batch([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "members"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "head", 1 << 20):
        heads = [np.frombuffer(x, np.int64) for x in batch.column("head").to_pylist()]
        sizes = [len(x) for x in heads]
        if not sum(sizes):
            continue
        keys, pos = np.concatenate(heads), np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
        ids, n, root = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("set_id", "n", "root"))
        yield pa.record_batch([pa.array(x) for x in (keys, ids, n, pos, root)], ["key", "set_id", "n", "pos", "root"])


def _may(n: np.ndarray, pos: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length and positional filter: a pair at 0.8 or more passes both at the first shingle that its heads share."""
    most = np.minimum(n[i] - pos[i], n[j] - pos[j]).astype(np.int64)
    return alike(n[i].astype(np.int64), n[j], most) & (DOWN * np.minimum(n[i], n[j]).astype(np.int64) >= UP * np.maximum(n[i], n[j]).astype(np.int64))


def _runs(batches: Iterator[pa.RecordBatch], judged) -> Iterator[pa.RecordBatch]:
    """judged(columns) for pieces of a stream sorted by its first column, never cut inside a run of equal keys."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        piece = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
        tail = int(np.searchsorted(piece[0], piece[0][-1], "left"))
        if held and tail == 0 and held[0][0][0] == piece[0][0]:
            held.append(piece)
            continue
        if held or tail:
            yield from judged(*(np.concatenate(x) for x in zip(*held, tuple(x[:tail] for x in piece), strict=True)))
        held = [tuple(x[tail:] for x in piece)]
    if held:
        yield from judged(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _pairs(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], 1), axis=0)


def _first(small: int):
    """Pairs of different components to verify, as (null, x, y, null, null); members of large runs of more than one component, as
    (key, set_id, null, n, pos)."""

    def judged(key, ids, n, pos, root) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        found, large = [], []

        def add(i: np.ndarray, j: np.ndarray) -> None:
            ok = (root[i] != root[j]) & _may(n, pos, i, j)
            found.append(_pairs(ids, i[ok], j[ok]))

        for s in np.unique(size[size > 1]).tolist():
            at = start[size == s]
            if s <= small:
                a, b = np.triu_indices(s, 1)
                step = max(1, (1 << 20) // len(a))
                for k in range(0, len(at), step):
                    add((at[k : k + step, None] + a).ravel(), (at[k : k + step, None] + b).ravel())
            else:
                at = at[(root[at[:, None] + np.arange(s)] != root[at, None]).any(1)]
                rows = (at[:, None] + np.arange(s)).ravel()
                large.append(rows)
                # The leader of each run, against all of the run; a set against itself is no pair.
                lead = at + (pos[rows] / n[rows]).reshape(-1, s).argmin(1)
                i, j = np.repeat(lead, s), rows
                i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
                add(i, j)
        pair = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        none = lambda k, t: pa.nulls(k, t)
        names = ["key", "x", "y", "n", "pos"]
        if len(pair):
            k = len(pair)
            yield pa.record_batch([none(k, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]), none(k, pa.int32()), none(k, pa.int32())], names)
        for rows in large:
            yield pa.record_batch([pa.array(key[rows]), pa.array(ids[rows]), none(len(rows), pa.int64()), pa.array(n[rows]), pa.array(pos[rows])], names)

    return lambda batches: _runs(batches, judged)


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the large runs, sets outside the largest component with a leader among them and with a leader of that component."""

    def judged(key, n, ids, pos, root) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(key)], strict=True):
            if (root[a:b] == root[a]).all():
                continue
            _, which, count = np.unique(root[a:b], return_inverse=True, return_counts=True)
            share = pos[a:b] / n[a:b]
            out = a + np.flatnonzero(which != count.argmax())
            own = a + np.flatnonzero(which == count.argmax())
            i = np.r_[np.full(len(out), out[share[out - a].argmin()]), np.full(len(out), own[share[own - a].argmin()])]
            j = np.r_[out, out]
            ok = (root[i] != root[j]) & _may(n, pos, np.minimum(i, j), np.maximum(i, j))
            pair = _pairs(ids, i[ok], j[ok])
            yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["x", "y"])

    return _runs(batches, judged)


def _second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in the large runs."""

    def judged(key, n, ids, pos, root) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(key)], strict=True):
            if (root[a:b] == root[a]).all():
                continue
            for i in range(a, b - 1):
                stop = a + int(np.searchsorted(n[a:b], DOWN * int(n[i]) // UP, "right"))
                j = i + 1 + np.flatnonzero(root[i + 1 : stop] != root[i])
                j = j[_may(n, pos, np.full(len(j), i), j)]
                if len(j):
                    pair = _pairs(ids, np.full(len(j), i), j)
                    yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["x", "y"])

    return _runs(batches, judged)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for a, b in zip(batch.column("mx"), batch.column("my"), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64)
            ok.append(bool(alike(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True)))))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two sets share beyond what their heads share is behind the head of the one whose head ends first."""
    for batch in batches:
        ok = []
        for a, b, nx, ny in zip(batch.column("hx"), batch.column("hy"), batch.column("nx").to_pylist(), batch.column("ny").to_pylist(), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64)
            ok.append(bool(alike(nx, ny, len(np.intersect1d(a, b, assume_unique=True)) + max(nx - len(a), ny - len(b)))))
        yield batch.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))


def _checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the sets of the pairs (x, y) that are at 0.8 or more. Only texts that some pair names are read: of each set one."""
    heads = pairs.join(nodes.select(F.col("set_id").alias("x"), F.col("n").alias("nx"), F.col("head").alias("hx")), "x")
    heads = heads.join(nodes.select(F.col("set_id").alias("y"), F.col("n").alias("ny"), F.col("head").alias("hy")), "y")
    pairs = durable(heads.select("x", "y", "nx", "ny", "hx", "hy").mapInArrow(_hopeful, "x long, y long"))
    ids = pairs.select(F.explode(F.array("x", "y")).alias("set_id")).distinct()
    asked = durable(ids.join(nodes.select("set_id", "did", "th"), "set_id").select("did", "th"))
    sets = docs.join(asked.hint("shuffle_hash"), ["did", "th"], "left_semi").select("text").mapInArrow(_sets, "set_id long, members binary")
    sets = durable(sets.dropDuplicates(["set_id"]))
    both = pairs.join(sets.select(F.col("set_id").alias("x"), F.col("members").alias("mx")), "x")
    both = both.join(sets.select(F.col("set_id").alias("y"), F.col("members").alias("my")), "y")
    out = durable(both.select(F.col("x").alias("a"), F.col("y").alias("b"), "mx", "my").mapInArrow(_verified, "a long, b long"))
    for done in (pairs, asked, sets):
        forget(done)
    return out


def _printed(docs: DataFrame, nodes: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b): links of sets at 0.8 or more that meet by their fingerprints. prints: (set_id, fp); equal sets may have several."""
    classes = durable(prints.groupBy("fp").agg(F.min("set_id").alias("lead")))
    same = prints.join(classes, "fp").select(F.col("lead").alias("x"), F.col("set_id").alias("y"))
    near = simhash_dedup.links(classes).toDF("fx", "fy")
    near = near.join(classes.toDF("fx", "x"), "fx").join(classes.toDF("fy", "y"), "fy").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return _checked(docs, nodes, durable(same.unionByName(near).where("x <> y").distinct()))


def near_duplicates(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """doc_id, th (hash of the text), gid (the group's smallest set_id), component_id for every row of docs."""
    spark = docs.sparkSession
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("did"), text_hash(F.col("text")).alias("th"), text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A sixteenth of the texts, by hash, so that repeated or null doc_ids don't change the share.
    counted = docs.where(F.pmod("th", F.lit(SAMPLED)) == 0).select("text").mapInArrow(_shingles, "key long").groupBy("key").count()
    often = counted.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "key").limit(LAST).collect()
    last = spark.sparkContext.broadcast(np.array([r["key"] for r in reversed(often)], np.int64))
    every = durable(docs.select("doc_id", "th", "text").mapInArrow(_heads(last), "doc_id long, th long, fp long, set_id long, n int, head binary"))
    did = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    nodes = every.groupBy("set_id").agg(F.min(F.struct(did.alias("did"), F.col("th").alias("th"))).alias("one"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("head").alias("head"))
    nodes = durable(nodes.select("set_id", "one.did", "one.th", "least", "n", "head"))
    rows = durable(every.select("doc_id", "th", "set_id"))
    prints = durable(every.select("set_id", "fp").distinct())
    forget(every)
    near = _printed(docs, nodes, prints)
    roots = components.connected_components(near, FEW).toDF("set_id", "root")
    keyed = nodes.join(roots, "set_id", "left").select("set_id", "n", "head", F.coalesce("root", "set_id").alias("root"))
    keyed = keyed.mapInArrow(_keyed, "key long, set_id long, n int, pos int, root long")
    keyed = keyed.repartition(parts, "key").sortWithinPartitions("key", "n", "set_id")
    met = durable(keyed.mapInArrow(_first(small), "key long, x long, y long, n int, pos int"))
    links = near.unionByName(_checked(docs, nodes, durable(met.where("key is null").select("x", "y").distinct())))
    large = met.where("key is not null").select("key", F.col("x").alias("set_id"), "n", "pos")
    if not large.isEmpty():
        judges = [*[_led] * ROUNDS, _second]
        while judges:
            roots = components.connected_components(links, FEW).toDF("set_id", "root")
            dealt = large.join(roots, "set_id", "left").select("key", "n", "set_id", "pos", F.coalesce("root", "set_id").alias("root"))
            dealt = dealt.repartition(parts, "key").sortWithinPartitions("key", "n", "set_id")
            more = durable(dealt.mapInArrow(judges.pop(0), "x long, y long").distinct())
            found = _checked(docs, nodes, more)
            if found.isEmpty():
                judges = judges[-1:]  # leaders have no more to give: all pairs, then the end
            links = links.unionByName(found)
    named = components.named(nodes.select(F.col("set_id").alias("node"), "least"), links, FEW).withColumnRenamed("node", "set_id")
    return rows.join(named, "set_id").select("doc_id", "th", "gid", "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group stays: see ``without_copies``."""
    return without_copies(docs, near_duplicates(docs.select("doc_id", "text")))
