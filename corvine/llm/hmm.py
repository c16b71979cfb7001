"""LM scoring by a hidden Markov model; its parameters come from Baum-Welch counts aggregated across all partitions.

Method. Every training document is counted: words, A-Z lower-cased, and one end a document. The words with the largest counts,
``SPREAD`` times the square root of the number of training tokens of them, are symbols of their own; every other word belongs to one of
``CLASSES`` symbols by its last two bytes and, within it, has probability (c + 1) / (T + 1), T being the sum of c + 1 over the class's
training words: what is left goes to words never seen. States emit symbols. Every document is written once as an array of symbols. From
seeded random parameters rounds of Baum-Welch run, each over all training documents: each task adds its expected counts, one row a symbol,
and a hash aggregation adds the tasks' rows. Rounds end when the likelihood of all training documents grows by less than ``TOLERANCE`` of
itself, or after ``ROUNDS``. The scaled forward recursion then gives the exact likelihood of each whole text.

A text of more than ``PIECE`` tokens is cut into pieces that are worked on side by side: the matrix that each piece is to the recursion, the
product of its moves and emissions, gives what enters every piece from either side, so results are those of the whole text.

What reaches the driver and every worker, the words with symbols of their own and their parameters, grows with the square root of the
corpus; counts of all other words, needed for the base score and for the classes, are found by a shuffled join on the
word: every word of every document counts, however large the vocabulary. Of words with equal counts the smaller come first.

Defined cases. A null or empty text is one end. A null doc_id is not held out. Without training documents all counts are zero. Repeated
rows train and are scored as often as they occur. Words over 32 bytes are told apart by a 128-bit hash. A task holds 80 bytes for each token
of one text, or of ``TOGETHER`` tokens of several texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import durable, sliced

STATES, SPREAD, CLASSES, ROUNDS, TOLERANCE, PRIOR = 8, 4.0, 1024, 14, 1e-3, 20.0
#: Sequences are packed side by side up to so many tokens; longer ones than PIECE are cut.
TOGETHER, PIECE = 1 << 20, 2048
END = b"\n"  # no word holds it
_LEAST = -(1 << 63)


class Tokens:
    """The tokens of a batch of texts, without the ends: distinct words, and for each token its word and its text."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        flat, text = lists.flatten(), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves an empty piece
        coded = flat.filter(real).dictionary_encode()
        self.words = coded.dictionary.cast(pa.binary())
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.text = text.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
        self.lengths = np.bincount(self.text, minlength=len(texts)) + 1

    def keys(self) -> pa.Array:
        """A word of up to 32 bytes is its own key, a longer one has a hash."""
        long = pc.greater(pc.binary_length(self.words), 32)
        if not pc.any(long).as_py():
            return self.words
        hashed = pa.array([END + xxhash.xxh3_128_digest(w) for w in self.words.filter(long).to_pylist()], pa.binary())
        return pc.replace_with_mask(self.words, long, hashed)

    def places(self, listed: pa.Array) -> np.ndarray:
        """Of each distinct word its place in ``listed``, -1 where it isn't."""
        return pc.fill_null(pc.index_in(self.words, value_set=listed), -1).to_numpy(zero_copy_only=False)

    def classes(self) -> np.ndarray:
        end = np.frombuffer(self.words.buffers()[1], np.int32)[self.words.offset :][: len(self.words) + 1].astype(np.int64)
        data = np.frombuffer(self.words.buffers()[2] or b"", np.uint8)
        last = data[end[1:] - 1].astype(np.int64)
        one = end[1:] - end[:-1] > 1
        return _class(last, np.where(one, data[np.maximum(end[1:] - 2, 0)], 0).astype(np.int64))


def _class(last, before):
    return ((before * 256 + last + 1) * 2654435761 >> 12) % CLASSES


def class_of(word: bytes) -> int:
    return int(_class(word[-1], word[-2] if len(word) > 1 else 0))


def held_out(part: int = 2, parts: int = 7):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


# ---- counts ----


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        got = Tokens(batch.column("text"))
        names = ["key", "cls", "c"]
        count = np.bincount(got.code, minlength=len(got.words))
        yield pa.record_batch([got.keys(), pa.array(got.classes().astype(np.int32)), pa.array(count.astype(np.int64))], names)
        yield pa.record_batch([pa.array([END]), pa.array([class_of(END)], pa.int32()), pa.array([batch.num_rows], pa.int64())], names)


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, cls, c) for every token of docs."""
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "key binary, cls int, c long").groupBy("key").agg(F.first("cls").alias("cls"), F.sum("c").alias("c"))


# ---- the model ----


class Symbols(dict):
    """word -> symbol; a word without a symbol of its own has its class's."""

    own = 0

    def __missing__(self, word: bytes) -> int:
        return self.own + class_of(word)


@dataclass
class Model:
    words: list[bytes]
    counts: np.ndarray  # of the words with symbols of their own
    totals: np.ndarray  # T of each class
    n: int  # training tokens
    v: int  # distinct ones
    start: np.ndarray | None = None
    move: np.ndarray | None = None  # (states, states)
    emit: np.ndarray | None = None  # (symbols, states)

    def symbols(self) -> Symbols:
        s = Symbols(zip(self.words, range(len(self.words)), strict=True))
        s.own = len(self.words)
        return s

    def unigram(self) -> np.ndarray:
        u = np.concatenate([self.counts, self.totals]) + 1 / CLASSES
        return u / u.sum()


class Packed:
    """Sequences side by side, time by time, longest first: step t is a slice over those longer than t."""

    def __init__(self, seqs: list[np.ndarray]):
        lengths = np.fromiter(map(len, seqs), np.int64, len(seqs))
        self.order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(len(seqs), np.int64)
        self.rank[self.order] = np.arange(len(seqs))
        self.last = lengths[self.order] - 1
        alive = len(seqs) - np.searchsorted(np.sort(lengths), np.arange(lengths.max()), side="right")
        self.at = np.r_[0, np.cumsum(alive)]
        self.spans = list(zip(self.at[:-1].tolist(), alive.tolist(), strict=True))
        flat = np.concatenate(seqs)
        time = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.sym = np.empty(len(flat), np.int32)
        self.sym[self.at[time] + np.repeat(self.rank, lengths)] = flat


class Pieces:
    """Sequences cut into pieces: each piece's sequence, whether it is a sequence's first, and what enters it from either side."""

    def __init__(self, model: Model, seqs: list[np.ndarray], kind: type, back: bool):
        cuts = [[s[i : i + PIECE] for i in range(0, len(s), PIECE)] for s in seqs]
        number = np.fromiter(map(len, cuts), np.int64, len(cuts))
        self.all = [x for c in cuts for x in c]
        self.first = np.cumsum(number) - number
        self.owner = np.repeat(np.arange(len(seqs)), number)
        k = len(model.start)
        self.enter = np.tile(model.start, (len(self.all), 1))
        self.leave = np.ones((len(self.all), k))
        cut = np.flatnonzero(number > 1)
        which = np.flatnonzero(number[self.owner] > 1)
        whole = _matrices(model, [self.all[i] for i in which.tolist()], kind) if len(which) else None
        begin = 0
        for i in cut.tolist():
            a, n = int(self.first[i]), int(number[i])
            own = whole[begin : begin + n]
            begin += n
            for j in range(1, n):
                x = self.enter[a + j - 1] @ own[j - 1]
                self.enter[a + j] = x @ model.move / x.sum()
            for j in range(n - 2, -1, -1) if back else ():
                y = model.move @ (own[j + 1] @ self.leave[a + j + 1])
                self.leave[a + j] = y / y.sum()
        self.enter, self.leave = self.enter.astype(kind), self.leave.astype(kind)


def _by_state(x: np.ndarray, kind: type) -> np.ndarray:
    """A row a state: the recursions work on long rows, sequence beside sequence."""
    return np.ascontiguousarray(x.T.astype(kind))


def _matrices(model: Model, pieces: list[np.ndarray], kind: type) -> np.ndarray:
    """What each piece does to what enters it, but for a factor: emission, move, emission, and so on."""
    packed, k = Packed(pieces), len(model.start)
    # Emissions as multiples of their largest, so that a few steps without scaling neither vanish nor overflow.
    emit, move = _by_state(model.emit / model.emit.max(1, keepdims=True), kind), _by_state(model.move, kind)
    out = np.empty((len(pieces), k, k), kind)
    m = np.broadcast_to(np.eye(k, dtype=kind)[:, :, None], (k, k, len(pieces)))
    for t, (at, n) in enumerate(packed.spans):
        m = (m[:, :, :n] if not t else np.matmul(move, m[:, :, :n])) * emit[:, packed.sym[at : at + n]]
        if t % 8 == 7:
            m /= m.sum((0, 1))
        stop = packed.spans[t + 1][1] if t + 1 < len(packed.spans) else 0
        if stop < n:
            out[packed.order[stop:n]] = m[:, :, stop:].transpose(2, 0, 1)
    return out


def forward(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence."""
    pieces = Pieces(model, seqs, np.float64, False)
    packed = Packed(pieces.all)
    total = np.zeros(len(pieces.all))
    emit, move = _by_state(model.emit, np.float64), _by_state(model.move, np.float64)
    a = None
    for at, n in packed.spans:
        a = (pieces.enter[packed.order].T if a is None else move @ a[:, :n]) * emit[:, packed.sym[at : at + n]]
        c = a.sum(0)
        a /= c
        total[:n] += np.log10(c)
    return np.bincount(pieces.owner, weights=total[packed.rank], minlength=len(seqs))


def expected(model: Model, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts of starts, moves and emissions, and the log10 likelihood of all sequences."""
    k, kind = len(model.start), np.float32
    pieces = Pieces(model, seqs, kind, True)
    packed = Packed(pieces.all)
    emit, move = _by_state(model.emit, kind), _by_state(model.move, kind)
    seen = np.empty((k, len(packed.sym)), kind)
    for j in range(k):
        np.take(emit[j], packed.sym, out=seen[j])
    alpha = seen.copy()  # emissions first; each step turns its slice into the forward variables
    scale = np.empty(len(packed.sym), kind)
    prev = None
    for at, n in packed.spans:
        a = alpha[:, at : at + n]
        a *= pieces.enter[packed.order].T if prev is None else move @ prev[:, :n]
        c = a.sum(0)
        a /= c
        scale[at : at + n], prev = c, a
    seen /= scale
    # What leaves a piece at its end, scaled so that forward and backward variables multiply to one.
    last = alpha[:, packed.at[packed.last] + np.arange(len(packed.last))]
    leave = np.ascontiguousarray(pieces.leave[packed.order].T)
    leave /= (last * leave).sum(0)
    moves = np.zeros((k, k))
    after, back = np.zeros((k, 0), kind), np.ascontiguousarray(move.T)  # after: emission times beta over scale of the next step
    for at, n in reversed(packed.spans):
        a, more = alpha[:, at : at + n], after.shape[1]
        beta = np.concatenate([back @ after, leave[:, more:n]], 1)
        moves += a[:, :more] @ after.T
        after = seen[:, at : at + n]
        after *= beta
        a *= beta
    inner = np.setdiff1d(np.arange(len(pieces.all)), pieces.first)  # pieces that another comes before
    moves += last[:, packed.rank[inner - 1]] @ after[:, packed.rank[inner]].T
    starts = alpha[:, packed.rank[pieces.first]].sum(1).astype(float)
    emissions = np.stack([np.bincount(packed.sym, weights=alpha[j], minlength=len(model.emit)) for j in range(k)], 1)
    return starts, moves * model.move, emissions, float(np.log10(scale).sum(dtype=float))


def improved(model: Model, starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray) -> Model:
    """The next parameters: expected counts with a little of the unigram and of an even spread added."""
    k = moves.shape[0]
    start = (starts + 1) / (starts + 1).sum()
    move = (moves + 1) / (moves + 1).sum(1, keepdims=True)
    emit = emissions + PRIOR * model.unigram()[:, None]
    return Model(model.words, model.counts, model.totals, model.n, model.v, start, move, emit / emit.sum(0, keepdims=True)) if k else model


def vocabulary(counts: DataFrame, own: int | None = None) -> Model:
    """The list of frequent words, class totals and corpus sums of a count table; ``own`` is for tests."""
    whole = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    own = math.ceil(SPREAD * math.sqrt(whole["n"])) if own is None else own
    plain = counts.where(F.substring("key", 1, 1) != F.lit(END))  # words themselves: neither the end nor hashes
    # Bands of counts narrow the table to little more than the list; only the band that the list ends in is sorted.
    band = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    least, room = None, own
    for r in sorted(plain.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("v")).collect(), key=lambda r: -r["band"]):
        if r["v"] > room:
            break
        least, room = r["band"], room - r["v"]
    else:
        room = 0
    listed = plain.where(band >= least) if least is not None else plain.limit(0)
    if room:
        broken = plain if least is None else plain.where(band < least)
        top = broken.agg(F.max(band)).first()[0]
        listed = listed.unionByName(broken.where(band == top).orderBy(F.desc("c"), "key").limit(room))
    table = listed.select("key", "c").unionByName(counts.where(F.col("key") == F.lit(END)).select("key", "c")).toArrow()
    top = sorted(zip(table["key"].to_pylist(), table["c"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    if all(w != END for w, _ in top):
        top.append((END, 0))
    totals = np.zeros(CLASSES)
    for r in counts.groupBy("cls").agg(F.sum(F.col("c") + 1).alias("t")).collect():
        totals[r["cls"]] = r["t"]
    for w, c in top:
        if c:
            totals[class_of(w)] -= c + 1
    return Model([w for w, _ in top], np.array([c for _, c in top], np.int64), totals, whole["n"], whole["v"])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Sequences of several batches, up to ``TOGETHER`` tokens: long ones cost less side by side."""
    held: list[np.ndarray] = []
    size = 0
    for batch in sliced(batches, "s", 4 * TOGETHER):
        new = [np.frombuffer(x, np.int32) for x in batch.column("s").to_pylist()]
        n = sum(map(len, new))
        if held and size + n > TOGETHER:
            yield held
            held, size = [], 0
        held += new
        size += n
    if held:
        yield held


def _expecting(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k = len(model.start)
        sums = None
        for seqs in _together(batches):
            got = expected(model, seqs)
            sums = got if sums is None else tuple(a + b for a, b in zip(sums, got, strict=True))
        if sums is None:
            return
        starts, moves, emissions, likelihood = sums
        # symbol -2 - k: likelihood; -1 - k: starts; -k to -1: moves; from 0: emissions
        rows = np.concatenate([np.full((1, k), likelihood), starts[None], moves, emissions])
        at = np.flatnonzero(rows.any(1))
        yield pa.record_batch([pa.array(at.astype(np.int32) - 2 - k), *(pa.array(rows[at, j]) for j in range(k))], ["symbol", *(f"s{j}" for j in range(k))])

    return run


def baum_welch(seqs: DataFrame, model: Model) -> tuple[Model, float]:
    """One round over all sequences of ``seqs`` (column s): the next model, and the log10 likelihood under this one."""
    sent, k = seqs.sparkSession.sparkContext.broadcast(model), len(model.start)
    names = [f"s{j}" for j in range(k)]
    rows = seqs.select("s").mapInArrow(_expecting(sent), "symbol int, " + ", ".join(f"{x} double" for x in names))
    table = rows.groupBy("symbol").agg(*[F.sum(x).alias(x) for x in names]).toArrow()
    sums = np.zeros((2 + k + len(model.emit), k))
    if table.num_rows:
        sums[table["symbol"].to_numpy() + 2 + k] = np.stack([table[x].to_numpy() for x in names], 1)
    sent.unpersist()
    return improved(model, sums[1], sums[2 : 2 + k], sums[2 + k :]), float(sums[0, 0])


def _start(model: Model, states: int) -> Model:
    """Seeded random parameters."""
    rng = np.random.default_rng(7)
    u = model.unigram()
    model.start = np.full(states, 1 / states)
    model.move = np.full((states, states), 0.3 / states) + np.eye(states) * 0.7
    emit = u[:, None] * rng.gamma(2.0, size=(len(u), states))
    model.emit = emit / emit.sum(0)
    return model


def _coded(sent):
    """Each text as an array of symbols, the end last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, end = pa.array(sent.value.words, pa.binary()), sent.value.words.index(END)
        for batch in sliced(batches, "text"):
            got = Tokens(batch.column("text"))
            of = got.places(listed)
            of = np.where(of >= 0, of, len(listed) + got.classes()).astype(np.int32)
            flat = np.full(len(got.code) + batch.num_rows, end, np.int32)
            flat[np.arange(len(got.code)) + got.text] = of[got.code]
            stop = np.cumsum(got.lengths)
            seqs = [flat[a:b].tobytes() for a, b in zip((stop - got.lengths).tolist(), stop.tolist(), strict=True)]
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "did", "th")), pa.array(seqs, pa.binary())], ["doc_id", "did", "th", "s"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, did and th, which tell rows apart, and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(_LEAST)).alias("did"), F.xxhash64("text").alias("th"), "text")


def coded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, did, th, s for every row of docs, written once."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return durable(_texts(docs).mapInArrow(_coded(sent), "doc_id long, did long, th long, s binary"))


def train(seqs: DataFrame, model: Model, states: int = STATES, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Model:
    """Rounds of Baum-Welch over ``seqs`` (column s), from seeded random parameters, until the likelihood hardly grows."""
    model, was = _start(model, states), None
    for _ in range(rounds):
        model, now = baum_welch(seqs, model)
        if was is not None and now - was < tolerance * abs(was):
            break
        was = now
    return model


# ---- scoring ----


def _rare(sent):
    """(did, th, key, tf) for the words without a symbol of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(sent.value.words, pa.binary())
        for batch in sliced(batches, "text"):
            got = Tokens(batch.column("text"))
            rare = got.places(listed) < 0
            at = np.flatnonzero(rare[got.code])
            pair, tf = np.unique(got.text[at] * len(got.words) + got.code[at], return_counts=True)
            text, word = pa.array(pair // max(len(got.words), 1)), pa.array(pair % max(len(got.words), 1))
            yield pa.record_batch([batch.column("did").take(text), batch.column("th").take(text), got.keys().take(word), pa.array(tf.astype(np.int32))], ["did", "th", "key", "tf"])

    return run


def _scored(sent):
    """Of what the model alone gives: n_known, sum of log10(c + 1), log10 probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        own = len(model.words)
        logs = np.log10(np.concatenate([model.counts + 1, np.ones(CLASSES)]).astype(float))
        inside = np.concatenate([np.zeros(own), -np.log10(model.totals + 1)])
        known = np.concatenate([model.counts > 0, np.zeros(CLASSES, bool)])
        for batch in sliced(batches, "s", 4 * TOGETHER):
            seqs = [np.frombuffer(x, np.int32) for x in batch.column("s").to_pylist()]
            hidden = forward(model, seqs)
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("doc_id", "did", "th")), pa.array(map(len, seqs), pa.int64()),
                    pa.array([int(known[s].sum()) for s in seqs], pa.int64()), pa.array([float(logs[s].sum()) for s in seqs], pa.float64()),
                    pa.array([h + float(inside[s].sum()) for h, s in zip(hidden.tolist(), seqs, strict=True)], pa.float64()),
                ],
                ["doc_id", "did", "th", "n_tokens", "n_known", "logs", "hidden"],
            )

    return run


def score(docs: DataFrame, seqs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of docs, of which ``seqs`` is the ``coded`` form."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = ["did", "th"]
    rare = _texts(docs).select(*key, "text").mapInArrow(_rare(sent), "did long, th long, key binary, tf int").join(counts.select("key", "c"), "key")
    rare = rare.groupBy(*key).agg(F.sum("tf").alias("rare_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    rows = seqs.mapInArrow(_scored(sent), "doc_id long, did long, th long, n_tokens long, n_known long, logs double, hidden double")
    # Equal rows share an identity and have added to its sums alike: they are divided by their number, then given back.
    rows = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("doc_id", "n_tokens", "n_known", "logs", "hidden")])
    rows = rows.join(rare, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    more = F.coalesce(F.col("rare_logs") / F.col("copies"), F.lit(0.0))
    return rows.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce(F.floor(F.col("rare_known") / F.col("copies")), F.lit(0))).cast("long").alias("n_known"), F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(math.log10(model.n + model.v + 1))).alias("base_score"), (F.col("hidden") + more).alias("score"),
    )


def trained_and_scored(docs: DataFrame) -> DataFrame:
    """Train on the documents that aren't held out and score all."""
    docs = docs.select("doc_id", "text")
    counts = durable(word_counts(docs.where(~held_out())))
    model = vocabulary(counts)
    seqs = coded(docs, model)
    model = train(seqs.where(~held_out()), model)
    return score(docs, seqs, model, counts).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
