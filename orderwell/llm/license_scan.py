"""License scans: an exact set-similarity join between blocks of text and license templates, in Spark functions alone.

Words are runs of digits, ASCII letters and non-ASCII characters, A-Z lower-cased. A template of m words is looked for in
blocks of 2m words that begin at every m-th word, so that any m consecutive words lie in one block. A block is a hit if it
holds at least THRESHOLD of the template's distinct words (its containment). No hit is missed:

* the vocabulary of all templates is counted over all texts, and every set is ordered by that count, rarest first;
* prefix filter: a block and a template that share t words share one within the first |set| - t + 1 words of both, so only
  blocks that hold a word of a template's prefix are made at all;
* length filter: fewer than t vocabulary words in a block cannot do;
* positional filter: if the first shared word stands at places i and j of the two ordered sets, they share at most
  min(|template| - i, |block| - j) words;
* what is left is verified by the intersection itself.

Everything about a document is worked out within its row from built-in functions, so nothing but the word counts is
shuffled (one row per vocabulary word) and no hot text, source or id gathers anywhere. Only these counts, as many as
TEMPLATES has distinct words, reach the driver.

Nulls, empty texts and texts without words have no words, places or labels and a score of 0. Null and repeated ids are rows
like others. Long texts are scanned whole. An empty table gives no rows. Other columns of the input are not read, whatever
their names. Ties of two templates give both labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import FOLD, read

#: Share of a template's distinct words a block must hold, in hundredths.
THRESHOLD = 90

# Phrases of the contract and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Public license statements and notices, with the identifier each one stands for.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """
        you may not use this file except in compliance with the License. You may obtain a copy of the License at
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License."""),
    ("bsd-2-clause", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution."""),
    ("bsd-3-clause", """
        may be used to endorse or promote products derived from this software without specific prior written
        permission."""),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", """
        To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to
        this software to the public domain worldwide. This software is distributed without any warranty."""),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software."""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely."""),
)

_ASCII = "".join(map(chr, range(128)))
_FOLDED = bytes(range(128)).translate(FOLD).decode()


@dataclass(frozen=True)
class Template:
    label: str
    length: int  # words, repeats counted
    tokens: tuple[str, ...]  # distinct, in the global order
    needed: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[: len(self.tokens) - self.needed + 1]


def template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def needed_words(distinct: int, threshold: int = THRESHOLD) -> int:
    return -(-threshold * distinct // 100)


def words_of(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    folded = F.translate(F.coalesce(text, F.lit("")), _ASCII, _FOLDED)
    return F.array_remove(F.split(folded, " "), "")


def global_order(words: DataFrame, column: str, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest first, by its places in all texts; ties by the word."""
    counts = (
        words.select(F.explode(column).alias("w")).where(F.col("w").isin(vocabulary)).groupBy("w").count()
    )
    n = {r["w"]: r["count"] for r in counts.collect()}  # one row per vocabulary word at most
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _hits(t: Template, ranked: list[str]) -> Column:
    """Blocks of the columns w (words), n (how many) and marks that meet a template."""
    m, size = t.length, len(t.tokens)
    last = F.greatest(F.ceil(F.col("n") / m).cast("int") - 1, F.lit(1))
    spots = F.filter("marks", lambda s: s["w"].isin(list(t.prefix)))
    near = F.flatten(F.transform(spots, lambda s: F.array(F.floor(s["i"] / m), F.floor(s["i"] / m) - 1)))
    starts = F.filter(F.array_distinct(near), lambda k: (k >= 0) & (k < last))
    ordered, tokens = _texts(ranked), _texts(t.tokens)
    blocks = F.transform(
        starts,
        lambda k: F.struct(
            (k * m).alias("start"),
            F.array_intersect(ordered, F.slice("w", (k * m + 1).cast("int"), 2 * m)).alias("block"),
        ),
    )
    long_enough = F.filter(blocks, lambda b: F.size(b["block"]) >= t.needed)

    def reachable(b: Column) -> Column:
        first = F.get(F.array_intersect(tokens, b["block"]), F.lit(0))
        left = size + 1 - F.array_position(tokens, first)
        right = F.size(b["block"]) + 1 - F.array_position(b["block"], first)
        return F.least(left, right) >= t.needed

    shared = F.transform(
        F.filter(long_enough, reachable),
        lambda b: F.struct(
            F.lit(t.label).alias("label"),
            b["start"].cast("bigint").alias("start"),
            F.least(b["start"] + 2 * m, F.col("n")).cast("bigint").alias("end"),
            F.size(F.array_intersect(tokens, b["block"])).alias("shared"),
            F.lit(size).alias("size"),
        ),
    )
    return F.filter(shared, lambda b: b["shared"] >= t.needed)


def _places(phrase: str, label: str) -> Column:
    """Where the words of a phrase stand consecutively in w."""

    def here(i: Column) -> Column:
        found = F.lit(True)
        for j, word in enumerate(phrase.split()):
            found = found & (F.get("w", i + j) == word)
        return found

    spots = F.filter(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0))), here)
    return F.transform(spots, lambda i: F.struct(F.lit(label).alias("label"), i.cast("bigint").alias("start")))


def scan_licenses(
    docs: DataFrame, templates=TEMPLATES, threshold: int = THRESHOLD, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, places (label, start of each phrase) and blocks (label, start, end, shared, size), in words."""
    split = [(label, template_words(x)) for label, x in templates]
    vocabulary = sorted({w for _, x in split for w in x})
    texts = docs.select(F.col(id).alias("doc_id"), words_of(F.col(text)).alias("w"))
    ranked = global_order(texts, "w", vocabulary)
    place = {w: i for i, w in enumerate(ranked)}
    known = [
        Template(label, len(x), tuple(sorted(set(x), key=place.get)), needed_words(len(set(x)), threshold))
        for label, x in split
    ]
    prefixes = sorted({w for t in known for w in t.prefix})
    rows = texts.select("doc_id", "w", F.size("w").alias("n"))
    # in between every word has a space of its own on either side
    apart = F.concat(F.lit(" "), F.array_join("w", "  "), F.lit(" "))
    any_phrase = F.lit(False)
    for phrase, _ in PHRASES:
        any_phrase = any_phrase | F.col("apart").contains(f" {phrase.replace(' ', '  ')} ")
    marks = F.filter(
        F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"].isin(prefixes)
    )
    no_marks = F.array().cast("array<struct<w:string,i:int>>")
    rows = rows.select(
        "doc_id", "w", "n", apart.alias("apart"),
        F.when(F.arrays_overlap("w", _texts(prefixes)), marks).otherwise(no_marks).alias("marks"),
    ).select("doc_id", "w", "n", "marks", any_phrase.alias("any_phrase"))
    no_places = F.array().cast("array<struct<label:string,start:bigint>>")
    no_blocks = F.array().cast("array<struct<label:string,start:bigint,end:bigint,shared:int,size:int>>")
    return rows.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        F.when(F.col("any_phrase"), F.flatten(F.array(*[_places(*p) for p in PHRASES])))
        .otherwise(no_places).alias("places"),
        F.when(F.size("marks") > 0, F.flatten(F.array(*[_hits(t, ranked) for t in known])))
        .otherwise(no_blocks).alias("blocks"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, phrase places, labels and score of every document.

    The score is 1 where a phrase stands, else the largest containment of a template, else 0.
    """
    found = scan_licenses(read(spark, sf_dir, "documents"))
    starts, own = F.col("places.start"), F.col("places.label")
    listed = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    parts = F.transform("blocks", lambda b: b["shared"].cast("double") / b["size"].cast("double"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(own).alias("base_labels"),
        listed(F.concat(own, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(parts), F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    """The same rows from all blocks of all texts against all templates, without any filter."""
    words = lambda text: f"[{', '.join(repr(w) for w in text)}]"
    phrases = ", ".join(f"({words(p.split())}, '{label}')" for p, label in PHRASES)
    split = [(label, template_words(x)) for label, x in TEMPLATES]
    templates = ", ".join(
        f"({words(sorted(set(x)))}, {len(x)}, {needed_words(len(set(x)))}, '{label}')" for label, x in split
    )
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), phrases(p, label) AS (VALUES {phrases}
), templates(t, m, needed, label) AS (VALUES {templates}
), spots AS (
    SELECT row_id, label, i - 1 AS spot
    FROM (SELECT row_id, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i FROM d, phrases WHERE len(w) >= len(p))
    WHERE w[i : i + len(p) - 1] = p
), blocks AS (
    SELECT row_id, w, t, m, needed, label, unnest(range(0, greatest(1, ((len(w) + m - 1) // m) - 1))) * m AS k
    FROM d, templates WHERE len(w) > 0
), found AS (
    SELECT row_id, label, len(list_intersect(t, w[k + 1 : k + 2 * m])) / len(t) AS part
    FROM blocks WHERE len(list_intersect(t, w[k + 1 : k + 2 * m])) >= needed
), based AS (
    SELECT row_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM spots GROUP BY row_id
), labelled AS (
    SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT row_id, label FROM spots UNION ALL SELECT row_id, label FROM found) GROUP BY row_id
), scored AS (SELECT row_id, max(part) AS part FROM found GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(CAST(part AS DOUBLE), 0.0) END AS score
FROM d LEFT JOIN based USING (row_id) LEFT JOIN labelled USING (row_id) LEFT JOIN scored USING (row_id)
"""


OP13_SQL = _sql()
