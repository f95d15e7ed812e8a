"""Market-basket affinity: which products share orders more often than by chance.

Exact, and without emitting all pairs of a huge basket:

* A product in fewer than ``min_pair_orders`` baskets cannot be in a reported
  pair, so it is dropped before any pairing.
* Baskets of ordinary size are paired directly: at most ``large_basket / 2``
  pairs per row.
* A larger basket only adds to pairs that can still reach the threshold.  Pairs
  seen in ordinary baskets are looked up in the large ones; pairs seen in large
  baskets alone need products that are in ``min_pair_orders`` large baskets.

What one task holds does not grow with the input: rows and pairs are counted
first, and the number of tasks follows the count.  Rows are dealt to chunks, one
per task; products and pairs are counted within a chunk before they move, so
that a pair in very many orders moves as one row per chunk.  Joins by product are
left to adaptive execution, which splits hot products.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.operators.facts import Tables, is_valid, order_headers
from orderwell.operators.validation import at_least, between, date_range, in_range
from orderwell.session import materialize

LARGE_BASKET = 200
SALTS = 64
ROWS_PER_TASK = 500_000
# A task opens at most 32 files (maxPartitionBytes by openCostInBytes) and, where it deals to many tasks, holds their rows.
ROWS_PER_FILE = 125_000
PAIR = ["ProductAId", "ProductBId"]


def tasks_for(rows: int) -> int:
    """One task per ROWS_PER_TASK, without an upper limit."""
    return max(1, -(-rows // ROWS_PER_TASK))


def _chunked(rows: DataFrame, tasks: int, *by: str) -> DataFrame:
    """Rows dealt by these columns to ``tasks`` chunks, each of them one task's share."""
    chunk = F.pmod(F.xxhash64(*by), F.lit(tasks)).cast("int")
    return rows.withColumn("__chunk", chunk).repartitionById(tasks, "__chunk")


def _counted(chunked: DataFrame, keys: list[str], tasks: int, name: str) -> DataFrame:
    """Rows per key, counted within chunks first."""
    within = chunked.groupBy("__chunk", *keys).agg(F.count(F.lit(1)).alias("__n"))
    return within.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("__n").alias(name))


def baskets_between(t: Tables, first: dt.date, last: dt.date) -> DataFrame:
    """Distinct (order, product) of valid orders in the date range."""
    orders = order_headers(t).filter(is_valid() & in_range("OrderDateTime", first, last)).select("OrderId")
    # Written first, as the number of tasks follows from the count.
    lines = materialize(t["order_items"].select("OrderId", "ProductId"), ROWS_PER_FILE)
    tasks = tasks_for(lines.count() + orders.count())
    return lines.repartition(tasks, "OrderId").join(orders.repartition(tasks, "OrderId"), "OrderId").distinct()


def _pairs(baskets: DataFrame, pairs: int) -> DataFrame:
    """Pairs of ordinary baskets: each product meets those before it in its order."""
    tasks = tasks_for(pairs)
    before = (
        Window.partitionBy("__chunk", "OrderId")
        .orderBy("ProductId")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    met = (
        _chunked(baskets.filter(F.col("OrderId").isNotNull()), tasks, "OrderId")
        .withColumn("__before", F.collect_list("ProductId").over(before))
        .select("__chunk", F.explode("__before").alias("ProductAId"), F.col("ProductId").alias("ProductBId"))
        .filter(F.col("ProductBId") > F.col("ProductAId"))
    )
    return _counted(met, PAIR, tasks, "PairOrders")


def _salted_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of few but huge baskets: one side is cut by product, the other repeated."""
    salted = rows.withColumn("__salt", F.pmod(F.hash("ProductId"), F.lit(SALTS)))
    repeated = rows.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    a = salted.withColumnRenamed("ProductId", "ProductAId")
    b = repeated.withColumnRenamed("ProductId", "ProductBId")
    return (
        a.join(b, ["OrderId", "__salt"])
        .filter(F.col("ProductBId") > F.col("ProductAId"))
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("PairOrders"))
    )


def _with_large_baskets(
    counted: DataFrame, large: DataFrame, large_count: int, min_pair_orders: int
) -> DataFrame:
    """Pair counts over ordinary (counted) and large baskets together, threshold applied."""
    reachable = counted.filter(F.col("PairOrders") + large_count >= min_pair_orders)
    holds_a = large.withColumnRenamed("ProductId", "ProductAId")
    holds_b = large.withColumnRenamed("ProductId", "ProductBId")
    added = (
        reachable.select(*PAIR)
        .join(holds_a, "ProductAId")
        .join(holds_b, ["OrderId", "ProductBId"])
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("__added"))
    )
    total = F.col("PairOrders") + F.coalesce(F.col("__added"), F.lit(0))
    result = reachable.join(added, PAIR, "left").select(*PAIR, total.alias("PairOrders"))
    if large_count >= min_pair_orders:
        often = (
            large.groupBy("ProductId")
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_pair_orders)
        )
        only_large = _salted_pairs(large.join(often, "ProductId", "left_semi"))
        result = result.unionByName(only_large.join(counted, PAIR, "left_anti"))
    return result.filter(F.col("PairOrders") >= min_pair_orders)


def pair_counts(
    baskets: DataFrame,
    min_pair_orders: int,
    large_basket: int = LARGE_BASKET,
) -> tuple[DataFrame, DataFrame, int]:
    """Pairs reaching the threshold, product supports, and the number of baskets."""
    baskets = materialize(baskets, ROWS_PER_FILE)
    tasks = tasks_for(baskets.count())
    # Dealt by both, as one order or one product may hold a third of the rows.
    dealt = _chunked(baskets, tasks, "OrderId", "ProductId")
    support = materialize(_counted(dealt, ["ProductId"], tasks, "ProductOrders"))
    frequent = support.filter(F.col("ProductOrders") >= min_pair_orders)
    # Orders without a frequent product stay as baskets, with products of NULL.
    flagged = materialize(
        baskets.join(frequent, "ProductId", "left").select(
            "OrderId", F.when(F.col("ProductOrders").isNotNull(), F.col("ProductId")).alias("ProductId")
        ),
        ROWS_PER_FILE,
    )
    sizes = _chunked(flagged, tasks, "OrderId").groupBy("__chunk", "OrderId").agg(F.count("ProductId").alias("__size"))
    is_large = F.col("__size") > large_basket
    counts = sizes.agg(
        F.count(F.lit(1)).alias("baskets"),
        F.count(F.when(is_large, F.lit(1))).alias("large"),
        F.coalesce(F.sum(F.when(~is_large, F.expr("__size * (__size - 1) div 2"))), F.lit(0)).alias("pairs"),
    ).first()
    kept = flagged.filter(F.col("ProductId").isNotNull())
    if counts["large"] == 0:
        pairs = _pairs(kept, counts["pairs"]).filter(F.col("PairOrders") >= min_pair_orders)
    else:
        huge = sizes.filter(is_large).select("OrderId")
        pairs = _with_large_baskets(
            _pairs(kept.join(huge, "OrderId", "left_anti"), counts["pairs"]),
            kept.join(huge, "OrderId", "left_semi"),
            counts["large"],
            min_pair_orders,
        )
    return pairs, support, counts["baskets"]


def product_affinity(
    t: Tables,
    start: dt.date | str,
    end: dt.date | str,
    min_pair_orders: int = 25,
    top_n: int = 50,
    large_basket: int = LARGE_BASKET,
) -> DataFrame:
    """Support, confidence both ways and lift of the strongest pairs."""
    first, last = date_range(start, end)
    at_least(min_pair_orders, 2, "min_pair_orders")
    between(top_n, 1, 500, "top_n")
    pairs, support, baskets = pair_counts(
        baskets_between(t, first, last), min_pair_orders, large_basket
    )
    if baskets == 0:
        raise ValueError("no baskets in the date range")

    def side(letter: str) -> DataFrame:
        return support.select(
            F.col("ProductId").alias(f"Product{letter}Id"),
            F.col("ProductOrders").cast("double").alias(f"__{letter}"),
        )

    both = pairs.join(side("A"), "ProductAId").join(side("B"), "ProductBId")
    together, total = F.col("PairOrders").cast("double"), F.lit(float(baskets))
    scored = both.withColumns(
        {
            "Support": together / total,
            "ConfidenceAToB": together / F.col("__A"),
            "ConfidenceBToA": together / F.col("__B"),
            "Lift": (together * total) / (F.col("__A") * F.col("__B")),
        }
    )
    strongest = [F.col("Lift").desc(), F.col("PairOrders").desc(), "ProductAId", "ProductBId"]
    top = scored.orderBy(*strongest).limit(top_n)
    # Ranks over the at most 500 kept rows equal ranks over all of them, since
    # every pair with a higher lift is kept as well.
    by_lift = Window.partitionBy(F.lit(0)).orderBy(F.col("Lift").desc())
    ranked = top.withColumn("LiftRank", F.dense_rank().over(by_lift))

    def name(letter: str) -> DataFrame:
        return t["products"].select(
            F.col("ProductId").alias(f"Product{letter}Id"),
            F.col("ProductName").alias(f"Product{letter}"),
        )

    return (
        ranked.join(name("A"), "ProductAId")
        .join(name("B"), "ProductBId")
        .select(
            "ProductAId", "ProductA", "ProductBId", "ProductB", "PairOrders", "Support",
            "ConfidenceAToB", "ConfidenceBToA", "Lift", "LiftRank",
        )
        .orderBy(*strongest)
    )
