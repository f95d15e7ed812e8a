"""Exact top-k by inner product: M-trees over shards of vectors, searched best first.

Method. Components become the integers floor(1024 x). With M the largest norm of a shard, a vector x is the point
(x, sqrt(M^2 - |x|^2)) and a query q the point (q, 0): their squared distance is |q|^2 + M^2 - 2 q.x, so the nearest points
have the highest products and a metric tree applies. Each shard (vectors dealt by hash of the id, so that one common vector
is spread) is a tree of pages. A page holds the entries below one routing vector; an entry has its distance to that
vector, and a covering radius where it routes further. The search takes pages from a heap by the least distance possible
in them, skips entries whose stored parent distance already rules them out by the triangle inequality, and computes
products for the others. A page is not opened if nothing in it can be nearer than the k-th result, or as near with a
smaller id. Products are integers; distances only prune, with a margin for rounding.

Queries and shards meet in blocks; each pair of a block of queries and a shard is a task's group, bounded in size. The
best k of a shard go to a window over each query.

Every row is a candidate for every query but itself. Rows with equal ids and different vectors are different candidates;
wholly equal rows are one entry that knows its number of copies, which is spread into rows in the result. Each query row
has results of its own, so a query id that stands in m rows has m results of each rank.

Vectors that are null, or hold a null or a component that is not finite, take no part, nor do null ids. Vectors of unequal
length are filled with zeros. Products must fit a long.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderwell.llm.common import read
from orderwell.session import materialize

K = 10
SHARD = 8192
BLOCK = 16384
PAGE = 128
FANOUT = 16


class Page:
    """Entries below one routing vector: vectors with ids (a leaf) or routing vectors with radii and pages."""

    __slots__ = ("vectors", "to_parent", "rows", "ids", "radii", "pages", "least_id")

    def __init__(self, vectors, to_parent, rows=None, ids=None, radii=None, pages=None):
        self.vectors, self.to_parent, self.rows, self.ids, self.radii, self.pages = vectors, to_parent, rows, ids, radii, pages
        self.least_id = int(ids.min()) if pages is None else min(p.least_id for p in pages)


class MTree:
    """The entries of a shard; `copies` says how many equal rows an entry stands for."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray):
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.top = float(squares.max(initial=0.0))
        points = np.column_stack([vectors.astype(np.float64), np.sqrt(np.maximum(0, self.top - squares))])
        # rounding of a distance, with room to spare
        self.slack = 1e-6 * (1 + math.sqrt(self.top))
        self.vectors, self.points, self.ids, self.copies = vectors, points, ids, copies
        self.root = self._grow(np.arange(len(ids)), None) if len(ids) else None

    def _distances(self, rows: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[row]) ** 2).sum(axis=1))

    def _grow(self, rows: np.ndarray, parent: int | None) -> Page:
        to_parent = np.zeros(len(rows)) if parent is None else self._distances(rows, parent)
        if len(rows) <= PAGE:
            return Page(self.vectors[rows], to_parent, rows=rows, ids=self.ids[rows])
        routes = rows[np.linspace(0, len(rows) - 1, FANOUT).astype(int)]
        nearest = np.array([self._distances(rows, r) for r in routes]).argmin(axis=0)
        groups = [rows[nearest == i] for i in range(FANOUT)]
        if max(map(len, groups)) > 0.9 * len(rows):  # mostly one place: equal parts by id instead
            rows = rows[np.argsort(self.ids[rows], kind="stable")]
            groups = np.array_split(rows, FANOUT)
        groups = [g for g in groups if len(g)]
        routes = np.array([g[0] for g in groups])
        pages = [self._grow(g, int(r)) for g, r in zip(groups, routes, strict=True)]
        radii = np.array([self._distances(g, r).max() for g, r in zip(groups, routes, strict=True)])
        up = np.zeros(len(routes)) if parent is None else self._distances(routes, parent)
        return Page(self.vectors[routes], up, radii=radii, pages=pages)

    def others(self, row: int, query: np.ndarray, own: int) -> int:
        """Copies of an entry besides the query's own row."""
        is_own = self.ids[row] == own and (self.vectors[row] == query).all()
        return int(self.copies[row]) - int(is_own)

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int, int]]:
        """(score, id, copies) of the k best entries, in order; `own` is the id of the query's row."""
        if self.root is None:
            return []
        length = float((query.astype(np.float64) ** 2).sum()) + self.top
        best: list[tuple[int, int, int]] = []  # a heap of (score, -id, row): its first is the worst kept
        # (least distance, turn, page, distance of the query to the page's routing vector or None at the root)
        heap, turn = [(0.0, 0, self.root, None)], 0
        while heap:
            least, _, page, to_route = heapq.heappop(heap)
            limit = math.inf if len(best) < k else math.sqrt(max(0.0, length - 2 * best[0][0])) + self.slack
            if least > limit:
                break
            radii = 0.0 if page.radii is None else page.radii
            if to_route is None or limit == math.inf:
                live = np.arange(len(page.to_parent))
            else:
                live = np.flatnonzero(np.abs(to_route - page.to_parent) - radii <= limit)
            scores = page.vectors[live] @ query
            if page.pages is None:
                entries = zip(scores.tolist(), page.ids[live].tolist(), page.rows[live].tolist(), strict=True)
                for score, i, row in entries:
                    if i == own and not self.others(row, query, own):
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -i, row))
                    elif (score, -i) > best[0][:2]:
                        heapq.heapreplace(best, (score, -i, row))
                continue
            distance = np.sqrt(np.maximum(0.0, length - 2.0 * scores))
            for j, d in zip(live.tolist(), distance.tolist(), strict=True):
                low = max(0.0, d - page.radii[j] - self.slack)
                child = page.pages[j]
                if len(best) == k:
                    worst, minus, _ = best[0]
                    reach = math.sqrt(max(0.0, length - 2 * worst))
                    if low > reach + self.slack or (low + 2 * self.slack >= reach and self._only_ties(child, query, worst, -minus)):
                        continue
                turn += 1
                heapq.heappush(heap, (low, turn, child, d))
        return [(s, -i, self.others(row, query, own)) for s, i, row in sorted(best, key=lambda x: (-x[0], -x[1]))]

    @staticmethod
    def _only_ties(page: Page, query: np.ndarray, worst: int, last: int) -> bool:
        """A leaf of equal vectors that ties with the k-th result and has no smaller id adds nothing."""
        if page.pages is not None or page.least_id < last or (page.vectors != page.vectors[0]).any():
            return False
        return int(page.vectors[0] @ query) <= worst


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id, v array<long>: floor(1024 x) of the vectors that take part, one per row."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(good, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.transform(x, lambda e: F.floor(e * 1024).cast("long")).alias("v"))
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled with zeros up to the width."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(column: pa.ChunkedArray) -> int:
    return pc.max(pc.list_value_length(column)).as_py() or 0


RESULT = "query_id long, asked long, times long, vec_id long, score long, copies long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest products of each query row (vec_id, v) with other rows (vec_id, v)."""
    counted = lambda rows: materialize(rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")))
    vectors, queries = counted(vectors), counted(queries)
    n_shards = max(1, -(-vectors.count() // shard))
    n_blocks = max(1, -(-queries.count() // block))
    # equal vectors are spread by id, equal ids by vector
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    there = vectors.select("*", dealt(n_shards, 1).alias("shard"), every(n_blocks).alias("block"))
    asked = queries.select(
        "*", F.xxhash64("vec_id", "v").alias("asked"), every(n_shards).alias("shard"), dealt(n_blocks, 2).alias("block")
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        width = max(_width(left.column("v")), _width(right.column("v")))
        numbers = lambda table, name: table.column(name).to_numpy()
        tree = MTree(_matrix(left.column("v"), width), numbers(left, "vec_id"), numbers(left, "copies"))
        names = [numbers(right, c).tolist() for c in ("vec_id", "asked", "copies")]
        rows = [
            (own, key, times, i, score, copies)
            for own, key, times, q in zip(*names, _matrix(right.column("v"), width), strict=True)
            for score, i, copies in tree.search(q, own, k)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in RESULT.split(", ")])

    found = there.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, RESULT)
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    # the best k entries of a query hold its best k rows
    entries = found.withColumn("entry", F.row_number().over(order)).where(F.col("entry") <= k)
    before = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = entries.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < k)
    last = F.least(F.col("before") + F.col("copies"), F.lit(k))
    ranked = placed.withColumn("rank", F.explode(F.sequence((F.col("before") + 1).cast("int"), last.cast("int"))))
    one_each = ranked.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return one_each.select("query_id", "rank", "vec_id", "score")


def op4_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whole_numbers(read(spark, folder, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP4_SQL = """
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.r <> q.r
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""
