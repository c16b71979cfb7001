"""Document fingerprints: 64-bit SimHash by weighted votes, and permuted block tables for search. DataFrame functions only.

Method. Terms are pairs of consecutive words (a lone word: itself); a term's weight is the length of its words, 16 at most, so
pairs of short, common words count less. Each term's hash votes with its weight for or against every bit. Votes are summed by
one hash aggregation with map-side combination, two 32-bit counters to a long, which no text that fits a row can overflow.

Search. The 64 bits are cut into 6 blocks; for each choice of 3 blocks there is a table keyed by those blocks' bits. Two
fingerprints at 3 or fewer differing bits differ in 3 blocks at most, so they agree in the other 3 and meet in one table at
least; every meeting is verified. Keys have 32 bits.

Likeness of two fingerprints is the cosine that SimHash estimates, cos(pi * differing / 64), 0 where that is negative; 1 for
equal ones.

Next documents. Ids and hashes of texts alone are put in order; each text is dealt once by its id and hash, and of the next text only as
many characters as are needed travel to it. No text is sorted, and null or repeated ids are spread by their texts' hashes.

Defined cases. A null text is empty; a text without words has fingerprint zero. Rows are in order of (doc_id, hash of the text), null
doc_ids first; rows equal in both stand in one place and have equal results. The place after the last is the first, so a lone one is its
own next. Equal texts have equal fingerprints; equal 64-bit hashes of different texts of one doc_id are taken for equal texts.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvine.llm.common import durable, numbered

HEAVIEST, BLOCKS, RADIUS = 16, 6, 3
_LEAST = -(1 << 63)
_SPACE = r"[ \t\n\x0B\f\r]+"


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), _SPACE, " ")), " ")


def terms(words: Column) -> Column:
    """Array of (h, w), hash and weight of each term, of an array of words. The last word has no pair unless it is alone."""

    def term(word: Column, after: Column) -> Column:
        return F.struct(F.xxhash64(word, after).alias("h"), F.least(F.length(word) + F.coalesce(F.length(after), F.lit(0)), F.lit(HEAVIEST)).cast("long").alias("w"))

    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
    return F.zip_with(firsts, F.slice(words, F.lit(2), F.size(words)), term)


def voted(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fp (signed long) of each row of texts; keys must be unique. A text without terms has one vote of no weight."""
    none = F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("w")))
    texts = texts.select(*keys, words_of(F.col("text")).alias("words"))
    votes = texts.select(*keys, F.explode(F.concat(none, terms(F.col("words")))).alias("t")).select(*keys, F.col("t.h").alias("h"), F.col("t.w").alias("w"))
    two = F.lit((1 << 32) | 1)
    sums = votes.groupBy(*keys).agg(F.sum("w").alias("all"), *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(two) * F.col("w")).alias(f"v{k}") for k in range(32)])
    fp = F.lit(0).cast("long")
    for k in range(32):
        for votes_, bit in ((F.col(f"v{k}").bitwiseAND(F.lit((1 << 32) - 1)), 1 << k), (F.shiftrightunsigned(f"v{k}", 32), 1 << (k + 32))):
            fp = fp.bitwiseOR(F.when(votes_ * 2 > F.col("all"), F.lit(bit - (1 << 64) if bit >> 63 else bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    differing = F.bit_count(a.bitwiseXOR(b))
    return F.when(differing == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.cos(F.lit(math.pi) * differing / F.lit(64.0))))


def _masks() -> list[int]:
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    out = [sum(x) for x in combinations(blocks, BLOCKS - RADIUS)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def within(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q, fp): every distinct fingerprint fp of ``index`` within the radius of a distinct fingerprint q of ``queries``."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the tables guarantee {RADIUS} or fewer differing bits")

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks()])
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.posexplode(keys).alias("table", "key"))

    met = keyed(queries, "q").hint("merge").join(keyed(index, "fp"), ["table", "key"])
    return met.where(F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius).select("q", "fp").distinct()


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (did, th, text, after), at least one for each place, and the places (did, th, doc_id, copies, next_did, next_th).

    after: of the next place's text as many characters as a quarter of the row's own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(_LEAST)).alias("did"), F.xxhash64("text").alias("th"), "text")
    places = rows.groupBy("did", "th", "doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max(F.floor(F.length("text") / 4)).cast("int").alias("tail"))
    places = durable(numbered(places, ["did", "th"]))
    n = max(places.count(), 1)
    key = ["did", "th"]
    after = places.select(((F.col("number") + n - 1) % n).alias("number"), F.col("did").alias("next_did"), F.col("th").alias("next_th"))
    before = places.select(((F.col("number") + 1) % n).alias("number"), F.col("did").alias("prev_did"), F.col("th").alias("prev_th"), F.col("tail").alias("wanted"))
    places = durable(places.join(after.hint("merge"), "number").join(before.hint("merge"), "number"))
    texts = rows.select(*key, "text")
    heads = texts.join(places.select(*key, "prev_did", "prev_th", "wanted").hint("shuffle_hash"), key)
    heads = heads.select(F.col("prev_did").alias("did"), F.col("prev_th").alias("th"), F.expr("substring(text, 1, wanted)").alias("after")).dropDuplicates(key)
    return texts.join(heads.hint("shuffle_hash"), key), places.select(*key, "doc_id", "copies", "next_did", "next_th")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next for each row."""
    rows, places = with_next(docs)
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("after"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), edited.alias("text"))))
    key = ["did", "th"]
    texts = rows.select(*key, both.alias("x")).select(*key, "x.side", "x.text")
    sides = texts.withColumn("n_chars", F.length("text").cast("long")).withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    # Equal rows add the same votes, which changes no majority.
    fps = voted(sides, [*key, "side", "n_chars", "sha"])
    own = fps.groupBy(*key).agg(
        F.max(F.when(F.col("side") == 0, F.col("n_chars"))).alias("n_chars"), F.max(F.when(F.col("side") == 1, F.col("sha"))).alias("edited_sha256"),
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp"),
    )
    own = durable(own)
    nexts = own.select(F.col("did").alias("next_did"), F.col("th").alias("next_th"), F.col("fp").alias("next_fp"))
    out = own.join(places.hint("merge"), key).join(nexts.hint("merge"), ["next_did", "next_th"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
