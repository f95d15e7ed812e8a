"""Affinity counts against brute force, through every path for large baskets."""

import datetime as dt
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderwell.operators import basket
from orderwell.operators.basket import pair_counts, product_affinity
from shop import shop, when


def random_baskets(seed, orders=120, products=40, huge=4):
    rng = random.Random(seed)
    baskets = {o: set(rng.sample(range(products), rng.randrange(1, 6))) for o in range(orders)}
    for o in range(orders, orders + huge):
        baskets[o] = set(rng.sample(range(products), rng.randrange(25, products)))
    return baskets


@pytest.mark.parametrize("minimum", [2, 4, 5, 7])
@pytest.mark.parametrize("large", [3, 10, 10_000])
def test_pair_counts(spark, minimum, large):
    baskets = random_baskets(seed=minimum)
    rows = [(o, p) for o, items in baskets.items() for p in items]
    df = spark.createDataFrame(rows, "OrderId long, ProductId long")
    pairs, support, total = pair_counts(df, minimum, large_basket=large)
    want = Counter(
        pair for items in baskets.values() for pair in itertools.combinations(sorted(items), 2)
    )
    assert {(r[0], r[1]): r[2] for r in pairs.collect()} == {
        k: v for k, v in want.items() if v >= minimum
    }
    assert total == len(baskets)
    assert {r[0]: r[1] for r in support.collect()} == Counter(p for _, p in rows)


def test_affinity_dedupes_lines_and_skips_cancelled(spark):
    orders, items = [], []
    for o in range(1, 5):
        orders.append(dict(OrderId=o, OrderDate=when("2024-01-05T23:59:59"), StatusId=5 if o == 4 else 4))
        for n, p in enumerate((1, 2, 2)):
            items.append(dict(OrderItemId=o * 10 + n, OrderId=o, ProductId=p))
    t = shop(spark, orders=orders, order_items=items)
    row = product_affinity(t, "2024-01-01", "2024-01-05", min_pair_orders=2).collect()
    assert len(row) == 1
    assert (row[0]["PairOrders"], row[0]["Support"], row[0]["Lift"], row[0]["LiftRank"]) == (3, 1.0, 1.0, 1)
    with pytest.raises(ValueError):
        product_affinity(t, "2025-01-01", "2025-01-05", min_pair_orders=2)


@pytest.mark.parametrize("large", [3, 10_000])
def test_pairs_over_many_chunks(spark, monkeypatch, large):
    """A pair in every order, orders without a frequent product, and NULLs, dealt to many tasks."""
    monkeypatch.setattr(basket, "ROWS_PER_TASK", 7)
    baskets = {o: {1, 2} | items for o, items in random_baskets(seed=3).items()}
    rows = [(o, p) for o, items in baskets.items() for p in items]
    odd = [(900, 901), (901, None), (902, 1), (902, None), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows + odd, "OrderId long, ProductId long")
    pairs, support, total = pair_counts(df, 4, large_basket=large)
    want = Counter(
        pair for items in baskets.values() for pair in itertools.combinations(sorted(items), 2)
    )
    assert want[1, 2] == len(baskets)
    assert {(r[0], r[1]): r[2] for r in pairs.collect()} == {k: v for k, v in want.items() if v >= 4}
    assert total == len(baskets) + 4
    assert {r[0]: r[1] for r in support.collect()} == Counter(p for _, p in rows + odd)


def test_what_one_task_holds_does_not_grow(spark, monkeypatch):
    monkeypatch.setattr(basket, "ROWS_PER_TASK", 100)
    rng = random.Random(5)
    for orders in (100, 400):
        rows = [(o, p) for o in range(orders) for p in rng.sample(range(300), 5)]
        pairs, _, _ = pair_counts(spark.createDataFrame(rows, "OrderId long, ProductId long"), 1)
        held = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) > 8 * orders and max(held) < 200


def test_written_rows_are_dealt_to_many_files(spark, monkeypatch):
    monkeypatch.setattr(basket, "ROWS_PER_FILE", 10)
    orders = [dict(OrderId=1, OrderDate=when("2024-01-05"), StatusId=4)]
    t = shop(spark, orders=orders, order_items=[dict(OrderItemId=i, OrderId=1, ProductId=i) for i in range(95)])
    found = basket.baskets_between(t, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert found.count() == 95 and len(found.inputFiles()) >= 10
