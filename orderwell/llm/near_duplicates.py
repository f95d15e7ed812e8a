"""Near duplicates: ProbMinHash signatures of weighted word shingles, banding, exact verification, components.

Method. A text is the set of its runs of five words, weighted 1 + ln(times it occurs); a text of fewer words, but not
none, is one shingle. For each shingle a Poisson process of rate `weight` is drawn from its hash; every arrival falls into
a random register, and a register keeps the shingle that arrives first. A process stops as soon as its next arrival is
later than all registers, so long texts draw little more than one arrival per shingle. Two texts agree in a register with
the probability Jaccard similarity of their weights. Registers are banded; texts that share a band are candidates. A text
with repeated shingles has a second signature, with all weights 1, whose bands follow plain Jaccard similarity; for other
texts both signatures are equal.

Texts with equal word sequences are one representative before banding. In a bucket (texts that share a band) not all pairs
are formed: the text that has most company in all its buckets is the pivot, and all are verified against it. What is not
joined to the largest component of a bucket afterwards (its outsiders) is compared with the bucket's members in blocks of
bounded size, but for pairs that one component holds already, and pairs that the triangle inequality rules out: both
distances are metric, so |d(x, pivot) - d(y, pivot)| <= 1 - similarity for a similar pair. So no link between
components is lost. A pair is similar if its probability Jaccard or its plain Jaccard similarity is 0.8 or more.

Result: one row per document with its class, the smallest doc_id in it, and the number of different texts in it. Null and
empty texts, and texts without words, are similar to equal texts only (null counts as empty). A row with a null id is in
the class of the rows with its words; without such rows that have an id its class is null. Repeated rows give repeated
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.llm.common import WordHash, arrow_map, by_place, give_back, mix, read, words
from orderwell.llm.components import connected_components
from orderwell.session import materialize

SHINGLE = 5
SIMILARITY = 0.8

#: At similarity 0.8 a pair shares a band with probability 1 - (1 - 0.8 ** 5) ** 20 = 0.9996.
BANDS, ROWS = 20, 5
REGISTERS = BANDS * ROWS

#: Shingle hashes of one side of a block of texts, in bytes.
BLOCK_BYTES = 4 << 20


def shingles(listed: list[bytes], hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes in order, and how often each occurs."""
    if not listed:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes.of(listed)
    size = min(SHINGLE, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out + np.uint64(i)) ^ h[i : len(h) - size + 1 + i]
    return np.unique(mix(out), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of REGISTERS shingle hashes per set; sets without shingles get zeros. All sets are drawn together."""
    sizes = [len(s) for s, _ in sets]
    doc = np.repeat(np.arange(len(sets)), sizes)
    item = np.concatenate([s for s, _ in sets]) if sets else np.zeros(0, np.uint64)
    rate = weights(np.concatenate([c for _, c in sets])) if sets else np.zeros(0)
    first = np.full(len(sets) * REGISTERS, np.inf)
    holder = np.zeros(len(sets) * REGISTERS, np.uint64)
    time, turn = np.zeros(len(item)), 0
    while len(item):
        with np.errstate(over="ignore"):
            draw = mix(item + np.uint64(0x9E3779B97F4A7C15) * np.uint64(turn + 1))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / rate
        register = doc * REGISTERS + (mix(draw) % np.uint64(REGISTERS)).astype(np.int64)
        better = time < first[register]
        at, when, who = register[better], time[better], item[better]
        order = np.argsort(when, kind="stable")[::-1]  # the earliest is written last
        first[at[order]] = when[order]
        holder[at[order]] = who[order]
        limit = first.reshape(-1, REGISTERS).max(axis=1)
        going = time < limit[doc]
        doc, item, rate, time, turn = doc[going], item[going], rate[going], time[going], turn + 1
    return holder.reshape(-1, REGISTERS)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each band of each signature; the number of the band is part of it."""
    parts = signature.reshape(-1, BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(parts), 1))
    for i in range(ROWS):
        out = mix(out) ^ parts[:, :, i]
    return mix(out).view(np.int64)


def all_bands(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[list[int]]:
    """The different bands of each set: of its signature, and of the one without weights where these matter."""
    out = bands_of(signatures(sets)).tolist()
    repeated = [i for i, (_, counts) in enumerate(sets) if (counts > 1).any()]
    plain = bands_of(signatures([(sets[i][0], np.ones_like(sets[i][1])) for i in repeated])).tolist()
    for i, bands in zip(repeated, plain, strict=True):
        out[i] = sorted({*out[i], *bands})
    return out


def plain_distance(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 1 - common / (len(a) + len(b) - common)


def weighted_distance(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """1 - probability Jaccard: the sum over common x of 1 / sum over y of max(a_y / a_x, b_y / b_x).

    With common x in order of a_x / b_x, y takes the first of the two where a_y / b_y > a_x / b_x; sums of a and b over the
    two sides of x in that order give every inner sum at once.
    """
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 1.0
    x, y = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    above = np.searchsorted(ratio, ratio, "right")
    sum_x = np.concatenate([[0], np.cumsum(x)])
    sum_y = np.concatenate([[0], np.cumsum(y)])
    inner = (only_a + sum_x[-1] - sum_x[above]) / x + (only_b + sum_y[above]) / y
    return 1 - float((1 / inner).sum())


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, text_key (of the text as it is), key (of the word sequence, or of a text without words), bands (null
    without words)."""

    def setup():
        hashes = WordHash()

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            listed = [words(t) for t in texts]
            keys = [sequence_key(t, ws) for t, ws in zip(texts, listed, strict=True)]
            # a slice may hold many copies; each word sequence is drawn once
            place = {k: i for i, k in enumerate(keys) if listed[i]}
            found = all_bands([shingles(listed[i], hashes) for i in place.values()])
            row = dict(zip(place, found, strict=True))
            bands = [row.get(k) for k in keys]
            return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "key": keys, "bands": bands}

        return work

    docs = documents.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string"))
    return arrow_map(docs, setup, "doc_id long, text_key long, key binary, bands array<long>")


def text_key() -> F.Column:
    return F.xxhash64(F.col("text").cast("string"))


def sequence_key(text: str | None, listed: list[bytes]) -> bytes:
    """Tells word sequences apart, and texts without words."""
    return xxhash.xxh3_128_digest(b" ".join(listed) if listed else "\0" + (text or ""))


def shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, items (sorted hashes), counts of the wanted representatives (rep, row: the key, and the id and text key of a
    row that has it; the id, which may be null, only keeps copies of the text away)."""

    def setup():
        hashes = WordHash()

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            listed = [words(t) for t in texts]
            sets = [shingles(ws, hashes) for ws in listed]
            return {
                "rep": [sequence_key(t, ws) for t, ws in zip(texts, listed, strict=True)],
                "items": [s.tobytes() for s, _ in sets],
                "counts": [c.astype(np.int32).tobytes() for _, c in sets],
            }

        return work

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text")
    )
    rows = wanted.select(F.col("row.doc_id").alias("row_id"), F.col("row.text_key").alias("row_key")).distinct()
    same = (texts["text_key"] == rows["row_key"]) & texts["doc_id"].eqNullSafe(rows["row_id"])
    found = arrow_map(
        texts.join(rows, same, "left_semi").select("text"), setup, "rep binary, items binary, counts binary"
    )
    # repeated rows come along: each key once
    return found.join(wanted, "rep", "left_semi").dropDuplicates(["rep"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, plain, weighted: the distances of each pair."""
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a"), F.col("counts").alias("counts_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b"), F.col("counts").alias("counts_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "counts_a", "items_b", "counts_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, weighted = [], []
            last, held = None, None
            columns = [batch.column(c) for c in ("items_a", "counts_a", "items_b", "counts_b")]
            ids = batch.column("b").to_pylist()
            for i in range(batch.num_rows):
                a = np.frombuffer(columns[0][i].as_buffer(), np.uint64)
                wa = weights(np.frombuffer(columns[1][i].as_buffer(), np.int32))
                if ids[i] != last:
                    last = ids[i]
                    held = (
                        np.frombuffer(columns[2][i].as_buffer(), np.uint64),
                        weights(np.frombuffer(columns[3][i].as_buffer(), np.int32)),
                    )
                plain.append(plain_distance(a, held[0]))
                weighted.append(weighted_distance(a, wa, *held))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(plain, pa.float64()), pa.array(weighted, pa.float64())],
                names=["a", "b", "plain", "weighted"],
            )
        give_back()

    return both.mapInArrow(run, "a binary, b binary, plain double, weighted double")


def similar(similarity: float) -> F.Column:
    return F.least("plain", "weighted") <= 1 - similarity + 1e-9


def representative_classes(
    documents: DataFrame, reps: DataFrame, similarity: float = SIMILARITY
) -> DataFrame:
    """rep, component for the representatives (rep, row, bands) that are similar to another one."""
    banded = reps.where(F.col("bands").isNotNull()).select("rep", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(banded.join(sizes, "band"))
    # the text with most company in all its buckets is closest to the middle of a group
    company = shared.groupBy("rep").agg(F.sum("size").alias("company"))
    pivot = shared.join(company, "rep").groupBy("band").agg(F.max_by("rep", F.struct("company", "rep")).alias("pivot"))
    placed = materialize(shared.join(pivot, "band").select("band", "size", "rep", "pivot"))
    sets = materialize(shingle_sets(documents, reps.join(placed, "rep", "left_semi").select("rep", "row")))
    first = placed.where("rep != pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    known = materialize(verify(first, sets))
    links = known.where(similar(similarity)).select("a", "b")
    components = materialize(connected_components(links))
    more = materialize(_links_of_the_rest(placed, known, components, sets, similarity))
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    return components.select(F.col("node").alias("rep"), "component")


def _links_of_the_rest(placed, known, components, sets, similarity) -> DataFrame:
    """Links between components that share a bucket.

    The members of a bucket outside its largest component are its outsiders; every pair of two components has one. Blocks
    of outsiders meet blocks of members, both bounded in bytes; a block gives links, never its pairs.
    """
    near = known.select(
        F.col("a").alias("rep"), F.col("b").alias("pivot"), F.col("plain").alias("p"), F.col("weighted").alias("w")
    )
    label = components.select(F.col("node").alias("rep"), "component")
    sizes = sets.select("rep", F.length("items").alias("bytes"))
    rows = (
        placed.where("size > 2").join(near, ["rep", "pivot"], "left").join(label, "rep", "left").join(sizes, "rep")
        .select("band", "rep", "bytes", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("w", F.lit(0.0)).alias("w"),
                F.coalesce("component", "rep").alias("component"))
    )
    rows = materialize(rows)
    counts = rows.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    bands = (
        counts.groupBy("band")
        .agg(F.count("*").alias("parts"), F.sum("bytes").alias("all_bytes"),
             F.max_by(F.struct("component", "bytes"), F.struct("n", "component")).alias("main"))
        .where("parts > 1")
        .select("band", F.col("main.component").alias("main"),
                F.ceil(F.col("all_bytes") / BLOCK_BYTES).cast("int").alias("n_m"),
                F.ceil((F.col("all_bytes") - F.col("main.bytes")) / BLOCK_BYTES).cast("int").alias("n_o"))
    )
    rows = rows.join(bands, "band").join(sets, "rep")
    part = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # new names for both sides of the meeting, which come from the same rows
    columns = [F.col(c).alias(c) for c in ("band", "rep", "component", "p", "w", "items", "counts")]
    outsiders = rows.where("component != main").select(*columns, part(F.col("n_o")).alias("o"), every(F.col("n_m")).alias("m"))
    members = rows.select(*columns, part(F.col("n_m")).alias("m"), every(F.col("n_o")).alias("o"))

    def block(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = links_between(_texts(left), _texts(right), similarity) if left.num_rows and right.num_rows else []
        return pa.table({n: pa.array([x[i] for x in found], pa.binary()) for i, n in enumerate("ab")})

    keys = ["band", "o", "m"]
    return outsiders.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(block, "a binary, b binary")


class Text:
    __slots__ = ("rep", "component", "p", "w", "items", "weights", "plain")

    def __init__(self, rep, component, p, w, items, counts):
        self.rep, self.component, self.p, self.w = rep, component, p, w
        self.items = np.frombuffer(items, np.uint64)
        counts = np.frombuffer(counts, np.int32)
        self.weights, self.plain = weights(counts), bool((counts == 1).all())


def _texts(table: pa.Table) -> list[Text]:
    names = ("rep", "component", "p", "w", "items", "counts")
    return [Text(*row) for row in zip(*(table.column(n).to_pylist() for n in names), strict=True)]


def links_between(outsiders: list[Text], members: list[Text], similarity: float) -> list[tuple[bytes, bytes]]:
    """Links that join the components of similar pairs; pairs whose components are joined already are passed over.

    Both distances to the common pivot are known and metric, so a pair whose distances to it differ by more than
    1 - similarity cannot be similar. Where no shingle repeats, plain and probability Jaccard are the same.
    """
    reach = 1 - similarity + 1e-9
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    order = sorted(members, key=lambda t: (-t.p, t.rep))  # the far side of a group is nearest to what lies outside it
    sizes = np.array([len(t.items) for t in order])
    flat, owner = np.concatenate([t.items for t in order]), np.repeat(np.arange(len(order)), sizes)
    p, w = np.array([t.p for t in order]), np.array([t.w for t in order])
    plain = np.array([t.plain for t in order])
    found = []
    for x in outsiders:
        common = np.bincount(owner[np.isin(flat, x.items, assume_unique=False)], minlength=len(order))
        distance = 1 - common / (len(x.items) + sizes - common)
        able = (np.abs(x.p - p) <= reach) | (np.abs(x.w - w) <= reach)
        unsure = (common > 0) & able & ~(plain & x.plain)
        for i in np.flatnonzero(able & ((distance <= reach) | unsure)).tolist():
            y = order[i]
            if find(x.component) == find(y.component):
                continue
            if distance[i] <= reach or weighted_distance(x.items, x.weights, y.items, y.weights) <= reach:
                root[find(x.component)] = find(y.component)
                found.append((x.rep, y.rep))
    return found


def classified(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, key, component, class_id, n_texts for each row: as near_duplicates, and what tells texts and
    classes apart."""
    rows = materialize(signed(documents))
    reps = materialize(
        rows.groupBy(F.col("key").alias("rep")).agg(
            F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_key")).alias("row"), F.first("bands").alias("bands")
        )
    )
    components = representative_classes(documents, reps, similarity)
    found = reps.select("rep", "doc_id").join(components, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    classes = found.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_texts"))
    found = found.join(classes, "component").select(F.col("rep").alias("key"), "component", "class_id", "n_texts")
    return rows.select("doc_id", "text_key", "key").join(found, "key")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, key, class_id, n_texts for each row: key tells word sequences apart, class_id is the least id of a class."""
    return classified(documents, similarity).select("doc_id", "key", "class_id", "n_texts")


def keep_one(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of documents without near duplicates: of each class the row with the least id stays, as it is.

    A null id comes after all others, so it stays only where its class has no id. Of rows that share the least id the one
    with the least hash of its text stays, and one of those that share both. Which rows stay is settled on ids and hashes;
    texts are shuffled once, and only rows with an id and text that repeat are compared as a whole.
    """
    rows = materialize(classified(documents, similarity).select("doc_id", "text_key", "component"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = rows.groupBy("component").agg(F.min(order).alias("row")).select("row.doc_id", "row.text_key")
    # a table of one row per class, hashed part by part next to the texts, which need no sorting
    times = rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    kept = kept.withColumnsRenamed({"doc_id": "kept_id", "text_key": "kept_key"})
    kept = materialize(kept.join(times, same).select("kept_id", "kept_key", "n"))
    plain = by_place(documents)
    doc_id, text = (F.col(f"c{documents.columns.index(c)}") for c in ("doc_id", "text"))
    here = (F.xxhash64(text.cast("string")) == F.col("kept_key")) & doc_id.cast("long").eqNullSafe(F.col("kept_id"))
    once = plain.join(kept.where("n = 1").hint("shuffle_hash"), here, "left_semi")
    often = kept.where("n > 1")
    if not often.isEmpty():
        repeated = plain.withColumn("key", F.xxhash64(text.cast("string"))).join(often.hint("shuffle_hash"), here, "left_semi")
        names = [c for c in repeated.columns if c not in (f"c{documents.columns.index('doc_id')}", "key")]
        first = repeated.groupBy(doc_id, "key").agg(F.first(F.struct(*names)).alias("row"))
        once = once.unionByName(first.select(doc_id, "row.*"))
    return once.toDF(*documents.columns)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_texts", F.coalesce(F.col("doc_id") != F.col("class_id"), F.lit(False)).alias("duplicate"))
