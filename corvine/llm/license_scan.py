"""License scans: phrases that stand word by word, and an exact set-similarity join of text blocks with notice templates.
DataFrame functions only.

Method. For each template (a notice's text) a block is a window of a quarter more words than the template has, wherever it stands, across
lines; its set is that of its words. A template is found in a block if at least ``THRESHOLD`` of the template's distinct words are in it.
The join is exact: the words of templates are ordered by their frequency over all texts, rarest first; a block that meets the
threshold must hold one of the first |T| - need + 1 words (prefix filter, an equi-join on the word), and the words around that place must
hold ``need`` distinct words of the template (length and positional filter: words too far from the prefix word to share a window don't count).
What is left is verified window by window. Windows are formed only around the words of prefixes, as each that meets the threshold
holds one. Only the templates, a parameter of fixed size, and their words' counts are broadcast.

Defined cases. A null text is empty: no words, no labels. Repeated rows each give a row. Matches are joined back by doc_id and a hash of the
text, so rows that share a doc_id, or have none, don't share labels. Words, places and labels are those of whole texts; only A-Z are
lower-cased. Score: 1 if a phrase stands in the text, else the largest share of a template found, else 0.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notice templates: (label, text).
TEMPLATES = (
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("artistic", "licensed under the Artistic License 2.0"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the BSD License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("creative-commons", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("epl", "licensed under the Eclipse Public License"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
    ("reserved", "All rights reserved"),
)
#: Longer notices, as their licenses word them.
NOTICES = (
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
        Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so""",
    ),
)
#: Short notices differ by one word; at 0.9 a template of fewer than ten distinct words must be there as a whole.
THRESHOLD = 0.9
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def spaced(text: Column) -> Column:
    """The words of a text, A-Z lower-cased and one space apart."""
    return F.trim(F.regexp_replace(lowered(text), _APART, " "))


def words_of(text: str) -> list[str]:
    return [w for w in re.split(_APART, text.lower()) if w]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, did and th, which tell rows apart, and w, the words one space apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text"))
    return rows.select("doc_id", "did", "th", spaced(F.col("text")).alias("w"))


def phrase_places(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """doc_id, did, th, n_words, n_base, first_word, last_word, base_list (sorted labels) for each row."""
    rows = _rows(docs)
    rows = rows.withColumn("p", F.concat(F.lit(" "), "w", F.lit(" ")))
    found = {p: F.contains("p", F.lit(f" {p} ")) for p in phrases}
    some = F.lit(False)
    for x in found.values():
        some = some | x

    def starts(phrase: str) -> Column:
        parts = phrase.split(" ")

        def here(i: Column) -> Column:
            out = F.get("words", i) == F.lit(parts[0])
            for k, part in enumerate(parts[1:], 1):
                out = out & (F.coalesce(F.get("words", i + F.lit(k)), F.lit("")) == F.lit(part))
            return out

        return F.when(found[phrase], F.filter(F.sequence(F.lit(0), F.size("words") - 1), here)).otherwise(F.array().cast("array<int>"))

    rows = rows.withColumn("words", F.split("w", " ")).withColumn("some", some)
    at = F.when(F.col("some"), F.concat(*[starts(p) for p in phrases])).otherwise(F.array().cast("array<int>"))
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(found[p], F.lit(x)) for p, x in phrases.items()]))))
    rows = rows.select("doc_id", "did", "th", F.when(F.col("w") == "", 0).otherwise(F.size("words")).cast("long").alias("n_words"), at.alias("at"), labels.alias("base_list"))
    return rows.select(
        "doc_id", "did", "th", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"), "base_list",
    )


def _need(n: int, threshold: float) -> int:
    return max(1, next(k for k in range(n + 1) if k >= threshold * n - 1e-9))


def window_of(n_words: int) -> int:
    """Words of a block for a template of so many words."""
    return n_words + -(-n_words // 4)


def _filters(docs: DataFrame, templates, threshold: float) -> tuple[list[tuple], list[tuple]]:
    """(word, template) for the words of prefixes; (template, label, known, size, need, length of a window) for each template."""
    sets = [(i, label, sorted(set(words_of(text))), window_of(len(words_of(text)))) for i, (label, text) in enumerate(templates)]
    known = sorted({w for _, _, s, _ in sets for w in s})
    words = F.filter(F.split(spaced(F.col("text")), " "), lambda x: x.isin(known))
    counted = docs.select(F.explode(words).alias("w")).groupBy("w").count()
    often = {r["w"]: r["count"] for r in counted.collect()}  # no more rows than the templates have words
    prefixes, rows = [], []
    for i, label, s, length in sets:
        order = sorted(s, key=lambda w: (often.get(w, 0), w))
        need = _need(len(s), threshold)
        prefixes += [(w, i) for w in order[: len(s) - need + 1]]
        rows.append((i, label, s, len(s), need, length))
    return prefixes, rows


_TABLE = "template int, label string, known array<string>, size int, need int, length int"


def window_matches(docs: DataFrame, templates=TEMPLATES + NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """(did, th, template, label, share): templates of which some window holds at least the threshold."""
    spark = docs.sparkSession
    prefixes, rows = _filters(docs, templates, threshold)
    heads = F.array(*[F.lit(w) for w in sorted({w for w, _ in prefixes})])
    table = spark.createDataFrame(prefixes, "w string, template int").join(spark.createDataFrame(rows, _TABLE), "template")
    texts = _rows(docs).select("did", "th", F.split("w", " ").alias("words")).where(F.arrays_overlap("words", heads))
    reach = max(r[5] for r in rows)

    def near(i: Column) -> Column:
        first = F.greatest(i - (reach - 1), F.lit(1))
        return F.struct(F.get("words", i - 1).alias("w"), (i - first + 1).alias("i"), F.slice("words", first, F.lit(2 * reach - 1)).alias("near"))

    # The join comes before the words around a place are cut out, and these before anything is written or dealt.
    places = texts.select("did", "th", "words", F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.array_contains(heads, F.get("words", i - 1))).alias("at"))
    hits = places.select("did", "th", F.explode(F.transform("at", near)).alias("p")).select("did", "th", "p.*").join(F.broadcast(table), "w")
    own = F.greatest(F.col("i") - F.col("length") + 1, F.lit(1))
    hits = hits.withColumns({"near": F.slice("near", own, 2 * F.col("length") - 1), "i": F.col("i") - own + 1})
    hits = hits.where(F.size(F.array_intersect("near", "known")) >= F.col("need"))
    common = F.array_max(F.transform(F.sequence(F.lit(1), F.col("i")), lambda s: F.size(F.array_intersect(F.slice("near", s, F.col("length")), F.col("known")))))
    return hits.withColumn("common", common).where(F.col("common") >= F.col("need")).select("did", "th", "template", "label", (F.col("common") / F.col("size")).alias("share"))


def scan(docs: DataFrame, templates=TEMPLATES + NOTICES, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row."""
    phrases = phrases or PHRASES
    base = phrase_places(docs, phrases)
    found = window_matches(docs, templates, threshold).groupBy("did", "th").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    rows = base.join(found.hint("shuffle_hash"), ["did", "th"], "left")
    labels = F.array_sort(F.array_union("base_list", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
