"""Benchmark decontamination: an FM-index per shard of training text, searched for every phrase of the benchmark.

Method. Phrases are the windows of ten consecutive words of an item; an item of fewer words, but not none, is one phrase.
A shard is a few megabytes of documents inside one task. Its words become numbers; words that no phrase holds become
separators, and runs between separators that are too short for any phrase are left out, which loses no occurrence. Over
what remains stand a suffix array, the Burrows-Wheeler transform in a wavelet matrix, and samples of the suffix array.
All phrases are searched backwards together, their occurrences are located by walking to the next sample, and the word
ranges are merged into removal spans.

Benchmarks larger than a block are taken in blocks, each with a pass of its own over the text; nothing is cut.

Rows: one per document row, also for repeated rows. Null and empty texts have no words; null ids stay null. Items without
words have no phrase; an item with a null id is listed as the empty string; items with one id count once.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import SLICE_BYTES, by_place, change_rows, give_back, read, slices, words

WINDOW = 10

#: Bytes of text, and numbers, of one index; bytes of benchmark text sent to all tasks at once; distance of samples.
SHARD_BYTES = 4 * SLICE_BYTES
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20
SAMPLE = 8

#: A word before it is lower-cased.
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def suffix_array(numbers: np.ndarray) -> np.ndarray:
    """Positions in order of the suffixes, by doubling the length that is compared."""
    n, step = len(numbers), 1
    rank = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        there = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(there[1:] != there[:-1])])
        if n == 0 or new[order[-1]] == n - 1 or step >= n:
            return order
        rank, step = new, step * 2


class WaveletMatrix:
    """Rank and access over numbers below 2 ** levels, for arrays of queries at once."""

    def __init__(self, numbers: np.ndarray):
        self.levels = max(1, int(numbers.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (numbers >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]))
            self.zeros.append(len(numbers) - int(bits.sum()))
            numbers = np.concatenate([numbers[bits == 0], numbers[bits == 1]])

    def rank(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each number stands before its position."""
        first = np.zeros_like(at)
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (number >> (self.levels - 1 - depth)) & 1 == 1
            first = np.where(bit, zeros + ones[first], first - ones[first])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - first

    def access(self, at: np.ndarray) -> np.ndarray:
        number = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[at + 1] - ones[at]
            number = number * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return number


class FMIndex:
    """Index of runs of numbers (1 and above) that each end in a 0. No phrase spans a 0."""

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        ends = numbers == 0
        # each separator is a letter of its own, below all words, so that runs never compare beyond their end
        letters = np.where(ends, np.cumsum(ends) - 1, numbers + int(ends.sum()))
        order = suffix_array(letters)
        self.size = n
        self.matrix = WaveletMatrix(numbers[order - 1])
        counts = np.bincount(numbers, minlength=1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        starts = np.concatenate([[True], ends[:-1]])
        sampled = (starts | (np.arange(n) % SAMPLE == 0))[order]
        self.mark = sampled
        self.sample = order[sampled]
        self.place = np.cumsum(sampled) - 1

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of equally long phrases: the first and the last row (exclusive) of the suffixes they start."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.flatnonzero((phrases < len(self.before) - 1).all(axis=1))
        high[np.setdiff1d(np.arange(len(phrases)), live)] = 0
        for column in range(phrases.shape[1] - 1, -1, -1):
            number = phrases[live, column]
            low[live] = self.before[number] + self.matrix.rank(number, low[live])
            high[live] = self.before[number] + self.matrix.rank(number, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back in the text until a sampled row is met."""
        rows, out, steps = rows.copy(), np.empty(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            here = self.mark[rows[todo]]
            out[todo[here]] = self.sample[self.place[rows[todo[here]]]] + steps
            todo = todo[~here]
            at = rows[todo]
            number = self.matrix.access(at)
            rows[todo] = self.before[number] + self.matrix.rank(number, at)
            steps += 1
        return out


class Phrases:
    """The phrases of a block of items, by length, with the items they come from."""

    def __init__(self, items: Iterable[tuple[object, str | None]]):
        self.number: dict[bytes, int] = {}
        known: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            listed = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            for i in range(max(1, len(listed) - WINDOW + 1) if listed else 0):
                known.setdefault(tuple(listed[i : i + WINDOW]), set()).add("" if item is None else str(item))
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for length in sorted({len(p) for p in known}):
            same = [p for p in known if len(p) == length]
            self.by_length[length] = (np.array(same, np.int64), [known[p] for p in same])
        self.shortest = min(self.by_length, default=0)
        self.longest = max(self.by_length, default=0)


def occurrences(numbers: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, phrase indexes) of all phrases in numbers; 0 parts runs. Long input is indexed in shards."""
    if not phrases.by_length or not len(numbers):
        return
    inside = numbers > 0
    change = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    wide = last - first >= phrases.shortest
    first, last = first[wide], last[wide]
    shard: list[tuple[int, int]] = []
    held = 0
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        while b - a > SHARD_WORDS:  # parts of one long run overlap by all but one word of the longest phrase
            yield from _in_shard(numbers, [(a, a + SHARD_WORDS)], phrases)
            a += SHARD_WORDS - phrases.longest + 1
        if held + b - a > SHARD_WORDS:
            yield from _in_shard(numbers, shard, phrases)
            shard, held = [], 0
        shard.append((a, b))
        held += b - a
    if shard:
        yield from _in_shard(numbers, shard, phrases)


def _in_shard(numbers, runs, phrases):
    sizes = np.array([b - a + 1 for a, b in runs])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(offsets[-1]) + np.repeat(np.array([a for a, _ in runs]) - offsets[:-1], sizes)
    text = numbers[np.minimum(place, len(numbers) - 1)].copy()
    text[offsets[1:] - 1] = 0
    index = FMIndex(text)
    for length, (listed, _) in phrases.by_length.items():
        low, high = index.search(listed)
        count = high - low
        which = np.repeat(np.arange(len(listed)), count)
        if len(which):
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            yield length, place[index.locate(rows)], which


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def search_texts(texts: list[str | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """(number of words, merged word ranges that are hit, item ids) of each text."""
    parts, sizes = [], []
    for t in texts:
        listed = words(t)
        sizes.append(len(listed))
        parts.append(np.fromiter(map(phrases.number.get, listed, itertools.repeat(0)), np.int64, len(listed)))
        parts.append(np.zeros(1, np.int64))
    numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.cumsum([0] + [n + 1 for n in sizes])
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    cover = np.zeros(len(numbers) + 1, np.int64)
    for length, at, which in occurrences(numbers, phrases):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        doc = np.searchsorted(starts, at, "right") - 1
        owners = phrases.by_length[length][1]
        pairs = np.unique(doc * len(owners) + which)
        for pair in pairs.tolist():
            items.setdefault(pair // len(owners), set()).update(owners[pair % len(owners)])
    hit = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]]))
    for a, b in zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist(), strict=True):
        doc = int(np.searchsorted(starts, a, "right")) - 1
        spans.setdefault(doc, []).append((a - int(starts[doc]), b - int(starts[doc])))
    return [(n, merged(spans.get(i, [])), items.get(i, set())) for i, n in enumerate(sizes)]


def without_words(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the characters from the first to the last word of each range of words; null stays null."""
    if not text or not len(spans):
        return text
    at = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, past = [], 0
    for start, end in spans:
        out.append(text[past : at[start][0]])
        past = at[end - 1][1]
    return "".join(out) + text[past:]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    held, size = [], 0
    for item, text in benchmark.select("item_id", F.col("text").cast("string")).toLocalIterator():
        held.append((item, text))
        size += len(text or "")
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


HITS = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def find_benchmark(documents: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_words, spans (merged word ranges) and items (sorted ids) for each row of documents."""
    spark = documents.sparkSession
    held = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    current = documents.select(
        *held,
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in blocks(benchmark):
        current = _pass(current, spark.sparkContext.broadcast(Phrases(block)))
    return current.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "spans", "items")


def _pass(current: DataFrame, shared) -> DataFrame:
    names = current.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                found = search_texts(part.column("text").to_pylist(), phrases)
                new = {"n_words": [n for n, _, _ in found]}
                before = part.column("spans").to_pylist()
                new["spans"] = [
                    [{"start": a, "end": b} for a, b in merged(s + [(x["start"], x["end"]) for x in old])]
                    for (_, s, _), old in zip(found, before, strict=True)
                ]
                before = part.column("items").to_pylist()
                new["items"] = [sorted(i.union(old)) for (_, _, i), old in zip(found, before, strict=True)]
                columns = [
                    pa.array(new[c], part.schema.field(c).type) if c in new else part.column(c) for c in names
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
        give_back()

    return current.mapInArrow(run, current.schema)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_benchmark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents with every hit passage cut from the text and n_chars counted anew."""
    names = documents.columns
    found = find_benchmark(documents, benchmark, tuple(names))
    # `found` has one column per kept one, then the three of HITS, whatever the kept ones are called
    found = by_place(found).select(*[f"c{i}" for i in range(len(names))], F.col(f"c{len(names) + 1}").alias("spans"))
    at = names.index("text")

    def setup():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hit = [i for i, n in enumerate(pc.list_value_length(batch.column("spans")).to_pylist()) if n]
            if not hit:
                return batch
            texts, spans = batch.column(at).to_pylist(), batch.column("spans")
            for i in hit:
                texts[i] = without_words(texts[i], [(s["start"], s["end"]) for s in spans[i].as_py()])
            return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

        return work

    out = change_rows(found, setup).drop("spans").toDF(*names)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return digest(find_benchmark(read(spark, folder, "documents"), read(spark, folder, "benchmark")))


OP5_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), phrases AS (
    SELECT DISTINCT item, least(len(w), 10) AS n,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM phrases
), spots AS (
    SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
), found AS (
    SELECT row_id, i, s.n, item
    FROM spots s JOIN phrases p ON s.n = p.n AND array_to_string(s.w[i : i + s.n - 1], ' ') = p.phrase
), hit AS (
    SELECT row_id, count(DISTINCT k) AS n_hit
    FROM (SELECT row_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY row_id
), listed AS (
    SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_id, item FROM found) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN listed USING (row_id)
"""
