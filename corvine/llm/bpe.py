"""BPE encoding and decoding with word ends, by a contiguous rank array.

Method. A text is cut at the special tokens' strings, normalised (NFC, runs of white space to one space, lower case letter by
letter) and cut into words. A word is an array of part ids and an array of the ranks of its adjacent pairs; the smallest
rank is searched by a scan, its boundary deleted and the two neighbouring ranks refreshed, until no pair has a rank. Words
of over ``LONG`` parts, for which repeated scans would be quadratic, use a heap over a linked list with the same order of
merges. Results of words are kept in a two-generation cache of bounded size. Decoding joins the ids' strings by spaces,
as a tokenizer file without a decoder asks for.

The tokenizer file is read on the driver from a path that is a parameter and sent once to every executor; its size is fixed.

Defined cases. A null text is the empty text: no ids, the empty string. Texts are processed whole. Other columns are ignored.
Combining marks added to Unicode after version 9 or so are ordered by today's tables in NFC, where the library may leave them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import sliced, sole

LONG, CACHE = 200, 250_000
_NONE = 1 << 62
#: Unicode's white space, and the patterns that cut words.
_WHITE = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{_WHITE}]+")
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


#: Ranges of letters and numbers that are newer than those the tokenizer's patterns know (Unicode 16).
_LATER = [
    (0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6),
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


def word_pattern() -> re.Pattern[str]:
    """The word pattern with letters and numbers as explicit ranges."""
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    later = "".join(f"{chr(a)}-{chr(b)}" for a, b in _LATER)
    classes = []
    for category in "LN":
        pattern = rf"(?V1)[\p{{{category}}}--[{later}]]+"
        found = regex.findall(pattern, every)
        classes.append("".join(f"{x[0]}-{x[-1]}" if ord(x[-1]) - ord(x[0]) == len(x) - 1 else x for x in found))
    letters, numbers = classes
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_WHITE}{letters}{numbers}]+")


#: Capitals newer than Python's own tables, and their small letters.
_NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
_NEW_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next one from U+0100."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class _Encoded(dict):
    """word -> little-endian ids; the younger generation, filled on demand."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.old = codec, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        got = self.old.get(word)
        if got is None:
            got = np.array(self.codec.merge(word), "<u4").tobytes()
        if len(word) <= LONG:
            self[word] = got
        return got


class Codec:
    """Encoder and decoder of one tokenizer file (kind: BPE with an end-of-word suffix, byte-level symbols)."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for s, i in (*vocab.items(), *self.special.items()):
            self.strings[i] = s
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + suffix] for s in symbols]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: (left id, right id) as one number -> rank and merged id as one number
        self.ranks = {vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = word_pattern()
        self.cache = _Encoded(self)

    def merge(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.final[raw[-1]]
        if len(parts) > LONG:
            return self._merge_long(parts)
        rank_of = self.ranks.get
        ranks = [rank_of(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = least & 0xFFFFF
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << 20 | parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 20 | parts[i], _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, rank_of = [*range(1, n), -1], [-1, *range(n - 1)], self.ranks.get
        heap = [(r >> 20, i, r & 0xFFFFF, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank_of(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) >= 0 and (r := rank_of(parts[x] << 20 | parts[y])) is not None:
                    heapq.heappush(heap, (r >> 20, x, r & 0xFFFFF, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def words(self, piece: str) -> list[str]:
        if piece.isascii():
            return _ASCII_WORDS.findall(piece.lower())
        piece = _RUNS.sub(" ", unicodedata.normalize("NFC", piece))
        # Letter by letter: a final capital sigma isn't treated as one.
        return self.pattern.findall(piece.replace("Σ", "σ").lower().translate(_NEW_CAPITALS))

    def encode(self, text: str | None) -> bytes:
        """ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        get = self.cache.__getitem__
        if not self.cut or "<|" not in text:
            return b"".join(map(get, self.words(text)))
        out = []
        for piece in self.cut.split(text):
            if piece in self.special:
                out.append(np.array([self.special[piece]], "<u4").tobytes())
            elif piece:
                out += map(get, self.words(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _run(sent, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One codec, with its cache, a Python worker, until tasks of another operator or file run there: it takes over 100 MB.
        owner = ("bpe", hash(sent.value))
        codec = sole(owner, lambda: Codec(sent.value))
        for batch in sliced(batches, "text", 4 << 20, owner):
            rows = []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text)
                back = codec.decode(ids)
                if with_ids:
                    rows.append((len(ids) // 4, np.frombuffer(ids, "<i4"), back))
                else:
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest()))
            n, ids, back = zip(*rows, strict=True)
            kind = pa.list_(pa.int32()) if with_ids else pa.string()
            names = ["doc_id", "n_tokens", *(("ids", "decoded") if with_ids else ("ids_sha256", "decoded_sha256"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, kind), pa.array(back, pa.string())], names)

    return run


def _sent(docs: DataFrame, path: str | None):
    with open(path or tokenizer_path(), "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, decoded."""
    return _input(docs).mapInArrow(_run(_sent(docs, path), True), "doc_id long, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of the decoded text."""
    return _input(docs).mapInArrow(_run(_sent(docs, path), False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
