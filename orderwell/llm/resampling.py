"""Target-distribution importance resampling of documents, over segments.

A document's features are its words and its pairs of consecutive words, hashed into BUCKETS by their checksum. The gain of
a bucket is how much likelier the target's texts are to hold it than the documents'; a document's weight is the floored mean
of its features' gains, and adding a Gumbel number to it and taking the highest scores draws without replacement in
proportion to the weights' exponentials.

Segments: newlines part words, so a text falls into lines. Lines repeat (copies, boilerplate), so the features of a line are
worked out once per distinct line of words and multiplied by its occurrences; the pairs across two lines (last word, first
word of the next line that has words) are added per text. The same sums are used for the weights: a line's gain is added
up once and joined to the places where the line stands.

At scale: the distinct lines are one shuffle of the texts, summed before it. What is joined per place is a row number and a
16-byte hash. A line held by at least one in HOT places is on a table of at most HOT rows, which is broadcast; the other
lines are shuffled, and none of them holds more than a 1/HOT share. Bucket counts are BUCKETS rows, which the driver reads.
The order of the scores is cut into ranges (`functions.ordered`), never one task.

Null and empty texts have no features, a weight of 0 and a score like others, and are never drawn. A null id is written as
the empty text in `7:<doc_id>` and stands before all ids in ties; repeated ids keep a row each. Long texts and lines are
read whole. An empty table gives no rows; without target texts every gain follows from t = T = 0. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.functions.ordered import Ordering, order_globally
from orderwell.llm.common import FOLD, read
from orderwell.session import materialize

BUCKETS = 10_000
SEED = 7
PERCENT = 25
LEAST_WORDS = 20

#: A line is hot if it stands at one place in HOT or more, so there are at most HOT such lines.
HOT = 10_000

_ASCII = "".join(map(chr, range(128)))
_FOLDED = bytes(range(128)).translate(FOLD).decode()
_LINES = _FOLDED[:10] + "\n" + _FOLDED[11:]


def lines_of(text: Column) -> Column:
    """The lines of a text that have words, each as its words parted by single spaces."""
    folded = F.translate(F.coalesce(text, F.lit("")), _ASCII, _LINES)
    lines = F.transform(F.split(folded, "\n"), lambda x: F.array_join(F.array_remove(F.split(x, " "), ""), " "))
    return F.filter(lines, lambda x: x != "")


def bucket(feature: Column) -> Column:
    return (F.crc32(feature.cast("binary")) % BUCKETS).cast("int")


def line_buckets(words: Column) -> Column:
    """The buckets of a line's words and of its pairs, one entry per feature."""
    pairs = F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), w)
    )
    return F.transform(F.concat(words, pairs), bucket)


def crossing_buckets(lines: Column) -> Column:
    """The buckets of the pairs across consecutive lines."""
    return F.transform(
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda x, i: bucket(
            F.concat_ws(" ", F.substring_index(F.get(lines, i), " ", -1), F.substring_index(x, " ", 1))
        ),
    )


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("a"), F.xxhash64(F.lit(SEED), line).alias("b")]


def segments(texts: DataFrame, id: Column, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two written tables: places (row, doc_id, keys of its lines, crossing) and lines (key, occurrences, buckets)."""
    lined = texts.select(id.alias("doc_id"), lines_of(F.col(text)).alias("lines"))
    places = materialize(
        lined.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.transform("lines", lambda x: F.struct(*_key(x))).alias("keys"),
            crossing_buckets(F.col("lines")).alias("crossing"),
        )
    )
    distinct = (
        lined.select(F.explode("lines").alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    )
    words = distinct.select("line", "times", F.split("line", " ").alias("words"))
    lines = materialize(
        words.select(
            *_key(F.col("line")), "times", F.size("words").alias("n_words"),
            line_buckets(F.col("words")).alias("buckets"),
        )
    )
    return places, lines


def bucket_counts(places: DataFrame, lines: DataFrame, name: str) -> DataFrame:
    """bucket and its features in all texts, occurrences multiplied in."""
    inner = lines.select("times", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("times").alias("n"))
    across = places.select(F.explode("crossing").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return inner.unionByName(across).groupBy("bucket").agg(F.sum("n").alias(name))


def gains(spark: SparkSession, own: DataFrame, target: DataFrame) -> list[int]:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, from tables (bucket, s) and (bucket, t)."""
    both = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(own, "bucket", "left")
    both = both.join(target, "bucket", "left").na.fill(0, ["s", "t"])
    rows = both.collect()  # BUCKETS rows
    all_s, all_t = sum(r.s for r in rows), sum(r.t for r in rows)
    d = lambda x: F.col(x).cast("double")
    share = (d("t") + 1.0) * F.lit(float(all_s + BUCKETS)) / ((d("s") + 1.0) * F.lit(float(all_t + BUCKETS)))
    counted = spark.createDataFrame([(r.bucket, r.s, r.t) for r in rows], "bucket int, s bigint, t bigint")
    gained = counted.select("bucket", F.floor(F.lit(1000.0) * F.log(share)).alias("gain")).collect()
    return [r.gain for r in sorted(gained)]


def weigh(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, n_words, n_features and weight of every document, against the texts of `target`."""
    spark = docs.sparkSession
    places, lines = segments(docs, F.col(id), text)
    aim = segments(target, F.lit(None).cast("string"))
    table = gains(spark, bucket_counts(places, lines, "s"), bucket_counts(*aim, "t"))
    # one literal: the optimizer folds the split
    gain = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")

    def total(buckets: str) -> Column:
        return F.aggregate(buckets, F.lit(0).cast("bigint"), lambda sum, b: sum + F.get(gain, b))

    each = materialize(lines.select("a", "b", "times", "n_words", total("buckets").alias("gain")))
    least = (each.agg(F.sum("times")).first()[0] or 0) / HOT
    hot = each.where(F.col("times") >= least).select("a", "b", F.col("n_words").alias("hot_words"), F.col("gain").alias("hot_gain"))
    spots = places.select("row", F.explode("keys").alias("key")).select("row", "key.a", "key.b")
    spots = spots.join(F.broadcast(hot), ["a", "b"], "left")
    sums = [F.sum("n_words").alias("n_words"), F.sum("gain").alias("gain")]
    known = spots.where(F.col("hot_gain").isNotNull()).select(
        "row", F.col("hot_words").alias("n_words"), F.col("hot_gain").alias("gain")
    )
    rest = (
        spots.where(F.col("hot_gain").isNull()).select("row", "a", "b")
        .join(each.where(F.col("times") < least).select("a", "b", "n_words", "gain"), ["a", "b"])
        .select("row", "n_words", "gain")
    )
    by_row = known.unionByName(rest).groupBy("row").agg(*sums)
    joined = places.select("row", "doc_id", total("crossing").alias("across")).join(by_row, "row", "left")
    n_words = F.coalesce("n_words", F.lit(0)).cast("bigint")
    summed = joined.select(
        "row", "doc_id", n_words.alias("n_words"),
        F.greatest(2 * n_words - 1, F.lit(0)).cast("bigint").alias("n_features"),
        (F.coalesce("gain", F.lit(0)) + F.col("across")).alias("gain"),
    )
    floored = F.expr("(gain - pmod(gain, n_features)) div n_features")
    return summed.select(
        "row", "doc_id", "n_words", "n_features",
        F.when(F.col("n_features") > 0, floored).otherwise(0).cast("bigint").alias("weight"),
    )


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) of a number u between 0 and 1 that a hash of seed and id fixes."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (of drawn documents) of every document."""
    scored = materialize(weigh(docs, target).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    rivals = scored.where(F.col("n_words") >= least_words)
    drawn = rivals.count() * percent // 100
    # a null id stands before all others
    keyed = rivals.select("row", "score", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("key"))
    ranked = order_globally(keyed, "key", [Ordering("score", descending=True, row_number="rank")])
    ranks = ranked.where(F.col("rank") <= drawn).select("row", "rank")
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, against the texts of benchmark."""
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
