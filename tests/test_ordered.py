"""Scale-safe ranks, running sums, quantiles and sequences against plain windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderwell.functions.ordered import Ordering, order_globally
from orderwell.functions.quantiles import exact_quantiles
from orderwell.functions.sequence import first_orders, neighbour_dates, number_orders, with_slices
from orderwell.functions.slices import cut_points, slice_of, with_places


def skewed(spark, n, seed, nulls=False):
    """A third of the rows share one value, a third sit in one group; with nulls, a third of the values and amounts are."""
    rng = random.Random(seed)
    rows = []
    for key in range(n):
        value = 7 if rng.random() < 0.34 else rng.randrange(0, max(2, n // 3))
        group = "hot" if rng.random() < 0.34 else rng.choice("abc")
        amount = Decimal(rng.randrange(0, 10_000)) / 100
        if nulls:
            value, amount = (None if rng.random() < 0.34 else x for x in (value, amount))
        rows.append((key, value, amount, group))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key long, value long, amount decimal(12,2), g string")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("group", [None, "g"])
@pytest.mark.parametrize("n, nulls", [(1, False), (4, False), (523, False), (3001, False), (3, True), (700, True)])
def test_global_order_equals_plain_window(spark, n, nulls, group, descending):
    df = skewed(spark, n, n, nulls)
    ordering = Ordering(
        "value",
        descending=descending,
        row_number="rn",
        rank="rk",
        dense_rank="dr",
        running_sums={"running": "amount"},
        ntiles={"t5": 5, "t10": 10},
        total="total",
    )
    got = order_globally(df, "key", [ordering], group=group, rows_per_slice=40)
    value = F.col("value").desc() if descending else F.col("value").asc()
    part = Window.partitionBy(*([group] if group else [F.lit(0)]))
    full = part.orderBy(value, "key")
    ties = part.orderBy(value)
    want = df.select(
        "*",
        F.row_number().over(full).alias("rn"),
        F.rank().over(ties).alias("rk"),
        F.dense_rank().over(ties).alias("dr"),
        F.count(F.lit(1)).over(part).alias("total"),
        F.sum("amount").over(full.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        F.ntile(5).over(full).alias("t5"),
        F.ntile(10).over(full).alias("t10"),
    )
    names = ["key", "value", "rn", "rk", "dr", "total", "running", "t5", "t10"]
    rows = lambda df: sorted(map(tuple, df.select(names).collect()), key=lambda row: row[0])
    assert rows(got) == rows(want)


def test_two_orderings_and_doubles(spark):
    df = skewed(spark, 700, seed=5).withColumn("d", F.col("amount").cast("double") / 3)
    got = order_globally(
        df,
        "key",
        [Ordering("d", row_number="a"), Ordering("amount", descending=True, rank="b")],
        rows_per_slice=25,
    )
    want = df.select(
        "key",
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("d", "key")).alias("a"),
        F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col("amount").desc())).alias("b"),
    )
    assert sorted(map(tuple, got.select("key", "a", "b").collect())) == sorted(
        map(tuple, want.collect())
    )


def test_empty_input(spark):
    df = skewed(spark, 3, seed=1).filter("key < 0")
    assert order_globally(df, "key", [Ordering("value", row_number="rn")]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 10, 4001])
def test_exact_quantiles(spark, n):
    df = skewed(spark, n, seed=n + 1)
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = list(exact_quantiles(df, "amount", shares, rows_per_slice=100).first())
    want = df.agg(
        *[F.percentile(F.col("amount").cast("double"), F.lit(s)).alias(f"q{i}") for i, s in enumerate(shares)]
    ).first()
    assert got == pytest.approx(list(want))


def test_slices_follow_the_rows_and_shares(spark):
    rows = [(i, 7 if i % 2 else i, Decimal(i) / 4, i * 0.1) for i in range(6000)]
    df = spark.createDataFrame(rows, "key long, v long, m decimal(12,2), d double").repartition(3)
    by_v, by_m, by_d = cut_points(df, ["v", "m", "d"], rows_per_slice=10)
    assert len(by_m.values) > 500 and len(by_d.values) > 500  # no upper limit
    assert dict(zip(by_v.values, by_v.shares))[7] in range(290, 311)  # half of 600 slices
    for name, cuts in (("m", by_m), ("d", by_d), ("v", by_v)):
        got = df.select(name, slice_of(name, cuts).alias("s")).collect()
        assert all(r["s"] == sum(c < r[name] for c in cuts.values) for r in got)
        assert len({r["s"] for r in got}) == len({sum(c < r[name] for c in cuts.values) for r in got})
    placed = with_places(df, "v", "key", by_v, cut_points(df, ["key"], 10)[0], ("p", "k"))
    sizes = placed.groupBy("p", "k").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 60 and sizes[1] <= 1300  # no slice is large, and there are not many more than rows ask for


def test_customer_with_most_orders_at_one_moment(spark):
    rng = random.Random(2)
    moments = ["2024-03-31 02:30:00", "2024-03-31 02:30:00.000001", "2024-03-31 03:00:00", "1969-12-31 23:59:59.5"]
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(2, 9), moments[0] if rng.random() < 0.8 else rng.choice(moments), rng.random() < 0.3) for i in range(1500)]
    df = spark.createDataFrame(rows, "OrderId long, CustomerId long, t string, cancelled boolean").select(
        "OrderId", "CustomerId", F.col("t").cast("timestamp_ntz").alias("OrderDateTime"), F.to_date("t").alias("OrderDate"), "cancelled"
    )
    w = Window.partitionBy("CustomerId").orderBy("OrderDateTime", "OrderId")
    valid = (~F.col("cancelled")).cast("int")
    sliced = with_slices(df, 20)
    assert sliced.where("CustomerId = 1").groupBy("__p", "__k").count().agg(F.max("count")).first()[0] < 200
    got = neighbour_dates(number_orders(df, ~F.col("cancelled"), "n", floor=20), floor=20)
    want = df.withColumns({
        "n": F.sum(valid).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "PreviousOrderDate": F.lag("OrderDate").over(w), "NextOrderDate": F.lead("OrderDate").over(w),
    })
    names = ["OrderId", "n", "PreviousOrderDate", "NextOrderDate"]
    rows = lambda df: sorted(map(tuple, df.select(names).collect()), key=lambda r: r[0])
    assert rows(got) == rows(want)


def orders_with_hot_customer(spark):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        customer = 1 if rng.random() < 0.4 else rng.randrange(2, 60)
        day = rng.randrange(0, 40)
        rows.append((i, customer, f"2024-01-01T00:00:00", day, rng.randrange(0, 86400), rng.random() < 0.2))
    df = spark.createDataFrame(rows, "OrderId long, CustomerId long, base string, day int, sec int, cancelled boolean")
    stamp = F.expr("CAST(base AS TIMESTAMP_NTZ) + make_dt_interval(day, 0, 0, sec)")
    return df.select(
        "OrderId", "CustomerId", stamp.alias("OrderDateTime"),
        stamp.cast("date").alias("OrderDate"), "cancelled",
    )


@pytest.mark.parametrize("floor", [0, 300, 10**9])
def test_customer_sequence_with_hot_customer(spark, floor):
    """Floor 0 slices every customer, 300 only the hot one, 10**9 none."""
    df = orders_with_hot_customer(spark)
    valid = ~F.col("cancelled")
    got = number_orders(df, valid, "n", floor=floor)
    w = Window.partitionBy("CustomerId").orderBy("OrderDateTime", "OrderId")
    want = df.withColumn(
        "n", F.sum(valid.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    assert sorted(map(tuple, got.select("OrderId", "n").collect())) == sorted(
        map(tuple, want.select("OrderId", "n").collect())
    )

    near = neighbour_dates(df, floor=floor)
    plain = df.withColumns(
        {
            "PreviousOrderDate": F.lag("OrderDate").over(w),
            "NextOrderDate": F.lead("OrderDate").over(w),
        }
    )
    names = ["OrderId", "PreviousOrderDate", "NextOrderDate"]
    key = lambda r: r[0]
    assert sorted(map(tuple, near.select(names).collect()), key=key) == sorted(
        map(tuple, plain.select(names).collect()), key=key
    )

    firsts = first_orders(df).select("CustomerId", "OrderId")
    ranked = df.withColumn("r", F.row_number().over(w)).filter("r = 1")
    assert sorted(map(tuple, firsts.collect())) == sorted(
        map(tuple, ranked.select("CustomerId", "OrderId").collect())
    )
