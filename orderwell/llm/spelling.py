"""Spelling variant grouping by asymmetric q-chunks, in Spark functions alone.

Words are the maximal runs of A-Z, a-z and the letters and signs from U+00C0 to U+00FF, A-Z lower-cased, with at least LENGTH
code points and MOST_RARE places over all texts. Two words are near if one edit (a code point inserted, deleted or replaced)
turns one into the other. The longer word u of such a pair (or the smaller one of two equally long) contributes its two
halves as chunks; the other word v contributes its grams of the halves' lengths. The edit lies in one half, so the other
half is a gram of v, at its own place if the edit comes after it and shifted by the difference in length (0 or 1) if it comes
before; grams at other places cannot belong to a near pair and are not made. As a half alone ("inter", "ation") is held by
very many words, the half with the edit is cut once more in two: one of its parts is preserved too, by the same reasoning, so
the join is on the half and that part together, which is three quarters of the word. Every pair that meets is verified by
its edit distance. No group of words that share a chunk is ever gathered or paired as a whole, and none is left out.

A word's form is its near word with the most places (ties: the smallest word) if these are at least FACTOR times its own; its
root is the last word on the way from form to form. Places grow by FACTOR with every step, so the way is short and pointer
doubling settles it in a few joins. Copies and hot sources cost no more than other rows: places are summed before they are
shuffled. The driver only sees whether a round changed anything.

Null and empty texts have no words. A null id is written as the empty text in `<doc_id>:<word>`. Repeated rows count again.
Long texts are read whole. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import read
from orderwell.session import materialize

LENGTH = 6
MOST_RARE = 5
FACTOR = 5
EVERY = 199

#: Parts of a word of length n begin at these quarters of n; the first two and the last two form its two chunks.
QUARTERS = range(4)


def runs(text: Column, least: int = LENGTH) -> Column:
    """Maximal runs of letters with at least `least` code points, A-Z lower-cased. All are of the basic plane."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))


def with_slips(run: Column, doc_id: Column) -> Column:
    """The run, less one code point where EVERY divides the checksum of `<doc_id>:<run>`."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (check % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % EVERY == 0, cut).otherwise(run)


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", slips: bool = True) -> DataFrame:
    """word, n for every word of at least LENGTH code points and MOST_RARE places."""
    each = docs.select(F.col(id).alias("doc_id"), F.explode(runs(F.col(text))).alias("run"))
    word = with_slips(F.col("run"), F.col("doc_id")) if slips else F.col("run")
    # a run of fewer than LENGTH code points only gets shorter
    return (
        each.select(word.alias("word")).where(F.length("word") >= LENGTH)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MOST_RARE)
    )


def _bound(length: Column, quarter: int) -> Column:
    return F.floor(length * quarter / 4).cast("int")


def _keys(word: Column, length: Column) -> Column:
    """Per quarter that may hold the edit: a hash of a word of `length` without that quarter.

    The part before it is taken from the beginning of the word, the part after it from its end, which is the place
    shifted by the difference where the word is one shorter.
    """
    kept = []
    for q in QUARTERS:
        after = length - _bound(length, q + 1)
        head = F.substring(word, F.lit(1), _bound(length, q))
        tail = F.substring(word, F.length(word) - after + 1, after)
        kept.append(F.xxhash64(F.lit(q), length, head, tail))
    return F.array(*kept)


def near_pairs(words: DataFrame) -> DataFrame:
    """u, v, n_u, n_v: every unordered pair of near words of a table (word, n) once."""
    length = F.length("word")
    chunks = words.select(F.col("word").alias("u"), F.col("n").alias("n_u"), F.explode(_keys(F.col("word"), length)).alias("k"))
    grams = words.select(
        F.col("word").alias("v"),
        F.col("n").alias("n_v"),
        F.explode(F.concat(_keys(F.col("word"), length), _keys(F.col("word"), length + 1))).alias("k"),
    )
    met = chunks.join(grams, "k").where(
        (F.length("u") > F.length("v")) | ((F.length("u") == F.length("v")) & (F.col("u") < F.col("v")))
    )
    near = met.where(F.levenshtein("u", "v", 1) == 1)
    # words such as "aab" and "ab" meet by more than one quarter
    return near.select("u", "v", "n_u", "n_v").distinct()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best (the near word with the most places), best_n."""
    pairs = materialize(near_pairs(words))
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("other"), F.col("n_v").alias("m")).unionByName(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("other"), F.col("n_u").alias("m"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    )
    return best.select("word", "n_near", F.col("best.other").alias("best"), (-F.col("best.m")).alias("best_n"))


def follow(forms: DataFrame) -> DataFrame:
    """word, root of a table (word, form) whose ways have no cycles, by pointer doubling."""
    roots = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(step, "root", "left")
        roots = materialize(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def group_variants(docs: DataFrame, id: str = "doc_id", text: str = "text", slips: bool = True) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word."""
    words = materialize(count_words(docs, id, text, slips))
    known = materialize(
        words.join(near_words(words), "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(F.col("best_n") >= FACTOR * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= FACTOR * F.col("n"), F.col("best_n")).alias("form_n"),
        )
    )
    roots = follow(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and near words of every word of documents, every slip of the contract made."""
    return group_variants(read(spark, sf_dir, "documents"))
