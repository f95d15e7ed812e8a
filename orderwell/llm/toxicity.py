"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once, hashed into 2 ** BITS places: words, beginnings of words (inflected languages),
pairs of neighbours, and pairs with one or two words between. Training is online: every coordinate has a learning rate of
its own, which falls with the gradients it has seen, and an L1 term that keeps it at zero until the evidence exceeds it.
Features are made on all tasks; the sequence of updates runs in one. What is left after L1 is some hundred weights (2 **
BITS at most, 8 MB), which are broadcast for scoring.

Bound: `most` labelled ids at most are trained on (those of least hash where there are more), each with one text: of the
texts of an id that of least hash. So the training task does not grow with the corpus, and copies do not reweight the
training. Scoring covers every row and every whole text.

Rows: one per document row, also for repeated rows. Null and empty texts get the score of a text without features. Null
ids cannot be labelled; they are scored and counted as training rows (held_out is false). Labels that are null are left
out; several labels of one id count as the highest. Without any label all scores are one half.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import arrow_map, change_rows, give_back, mix, read, slices, words
from orderwell.session import materialize

BITS = 20
EPOCHS = 3
MOST = 12_000
THRESHOLD = 0.3

#: Training texts that must hold a feature before it can get a weight.
MIN_SEEN = 3

#: Learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0

BEGINNINGS = (4, 5, 6)

#: Bytes of text whose features are made at once: about seven features a word, some 60 bytes of memory a byte of text.
AT_ONCE = 1 << 18


class Features:
    """Feature places of texts; remembers the hashes of words and of their beginnings."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.table = np.zeros((1 << 12, 1 + len(BEGINNINGS)), np.uint64)

    def _numbers(self, listed: list[list[bytes]]) -> np.ndarray:
        if len(self.index) > self.most:
            self._forget()
        index = self.index
        new = list(set(chain.from_iterable(listed)).difference(index))
        first = len(index)
        index.update(zip(new, range(first, first + len(new))))
        while len(index) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if new:
            digest = xxhash.xxh3_64_intdigest
            self.table[first : first + len(new), 0] = [digest(w) for w in new]
            for k, size in enumerate(BEGINNINGS, 1):
                self.table[first : first + len(new), k] = [digest(b"^" + w[:size]) for w in new]
        return np.fromiter(map(index.__getitem__, chain.from_iterable(listed)), np.int64)

    def of(self, texts: list[str | None], live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(document, place) of all features, repeated ones too; of those with a true `live` place if that is given."""
        listed = [words(t) for t in texts]
        docs = np.repeat(np.arange(len(listed)), [len(ws) for ws in listed])
        numbers = self._numbers(listed)
        owners, places = [docs[:0]], [docs[:0]]

        def add(owner: np.ndarray, hashes: np.ndarray) -> None:
            place = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
            keep = slice(None) if live is None else live[place]
            owners.append(owner[keep])
            places.append(place[keep])

        for k in range(1 + len(BEGINNINGS)):
            add(docs, self.table[numbers, k])
        word = self.table[numbers, 0]
        with np.errstate(over="ignore"):
            for gap in (1, 2, 3):
                same = np.flatnonzero(docs[gap:] == docs[:-gap])
                left, right = word[same], word[same + gap]
                add(docs[same], mix((left * np.uint64(2 * gap + 1) + np.uint64(gap)) ^ (right >> np.uint64(1))))
        return np.concatenate(owners), np.concatenate(places)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        docs, place = self.of(texts)
        both = np.unique(docs << BITS | place)
        cuts = np.searchsorted(both >> BITS, np.arange(len(texts) + 1))
        place = both & ((1 << BITS) - 1)
        return [place[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


BIAS = 1 << BITS


def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed-form minimiser of a coordinate: zero up to L1, then shrunk by its own rate."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def without_rare(parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Take features that fewer than MIN_SEEN texts hold out of (places, ends of texts), in place."""
    seen = np.zeros(BIAS, np.int64)
    for places, _ in parts:
        seen += np.bincount(places, minlength=BIAS)
    for i, (places, ends) in enumerate(parts):
        keep = seen[places] >= MIN_SEEN
        kept = np.concatenate([[0], np.cumsum(keep)])
        parts[i] = places[keep], kept[ends]


def train(rows: list[np.ndarray], labels: list[int]) -> np.ndarray:
    """The weights after EPOCHS passes in the given order; the last is the bias."""
    rows = [np.append(f, np.int32(BIAS)) for f in rows]
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(EPOCHS):
        for at, label in zip(rows, labels, strict=True):
            w = weight(z[at], n[at])
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weight(z, n)


def training_rows(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, label, places: one row for each of the ids of chosen(doc_id, label) that has a text."""
    hashed = texts.withColumn("text_key", F.xxhash64("text"))
    # `chosen` holds two numbers for each of a bounded number of ids; so does the text picked for each id
    picked = hashed.select("doc_id", "text_key").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    picked = materialize(picked.agg(F.min("text_key").alias("text_key")))

    def setup():
        features, seen = Features(), set()

        def work(batch: pa.RecordBatch) -> dict:
            # a task makes the features of an id once, however many rows repeat it
            ids, labels, texts = (batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))
            new = [i for i in range(len(ids)) if not (ids[i] in seen or seen.add(ids[i]))]
            sets = features.sets([texts[i] for i in new]) if new else []
            return {"doc_id": [ids[i] for i in new], "label": [labels[i] for i in new], "places": sets}

        return work

    rows = hashed.join(F.broadcast(picked), ["doc_id", "text_key"]).select("doc_id", "label", "text")
    rows = arrow_map(rows, setup, "doc_id long, label int, places array<int>", most=AT_ONCE)
    return rows.dropDuplicates(["doc_id"])


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST) -> np.ndarray:
    """Weights by place, the last is the bias. labels(doc_id, toxic): rows to learn from."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = training_rows(texts, materialize(chosen))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one array a batch, not one a text: what is let go returns to the system
        parts, ids, labels = [], [], []
        for batch in batches:
            places = batch.column("places")
            parts.append((places.values.to_numpy().astype(np.int32), places.offsets.to_numpy().astype(np.int64)))
            ids.append(batch.column("doc_id").to_pylist())
            labels.append(batch.column("label").to_pylist())
        lengths = [np.diff(ends) for _, ends in parts]
        order = sorted(
            (zlib.crc32(str(doc).encode()), doc, labels[k][i], int(lengths[k][i]), k, i)
            for k, docs in enumerate(ids)
            for i, doc in enumerate(docs)
        )
        without_rare(parts)
        rows = [parts[k][0][parts[k][1][i] : parts[k][1][i + 1]] for *_, k, i in order]
        weights = train(rows, [row[2] for row in order])
        at = np.flatnonzero(weights)
        parts, rows = [], []
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], names=["place", "weight"])
        give_back()

    # online training is a sequence: the bounded sample's features meet in one task
    got = rows.repartition(1).mapInArrow(one, "place long, weight double").toPandas()  # 2 ** BITS rows at most
    out = np.zeros(BIAS + 1)
    out[got["place"].to_numpy(dtype=np.int64)] = got["weight"].to_numpy()
    return out


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score for each row."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def setup():
        features, w = Features(), shared.value

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            return {"doc_id": batch.column("doc_id"), "score": score_texts(texts, features, w)}

        return work

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_map(docs, setup, "doc_id long, score double", most=AT_ONCE)


def score_texts(texts: list[str | None], features: Features, w: np.ndarray) -> np.ndarray:
    """Scores in 0 to 1; w has the bias at its end."""
    docs, place = features.of(texts, w != 0)
    both = np.unique(docs << BITS | place)
    total = np.bincount(both >> BITS, w[both & ((1 << BITS) - 1)], minlength=len(texts)) + w[BIAS]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def model_of(documents: DataFrame, labels: DataFrame, most: int = MOST) -> np.ndarray:
    """Fit on the labels that are not held out."""
    return fit(documents, labels.where(~held_out(F.col("doc_id"))), most)


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of documents."""
    scored = score(documents, model_of(documents, labels, most))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def reject_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents whose text scores below the threshold, as they are. Without usable labels all stay."""
    weights = model_of(documents, labels)
    if not weights.any():
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    at = documents.columns.index("text")

    def setup():
        features, w = Features(), shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            listed = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string())], ["text"])
            out = [score_texts(x.column(0).to_pylist(), features, w) for x in slices(listed, "text", AT_ONCE)]
            return batch.filter(pa.array(np.concatenate(out) < threshold)) if out else batch

        return work

    return change_rows(documents, setup)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))
