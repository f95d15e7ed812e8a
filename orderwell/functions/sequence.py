"""Per-customer order sequences that hold when one customer owns much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions.slices import cut_points, with_places
from orderwell.session import materialize

# A customer is hot above this share of all orders, so at most 1 / HOT_SHARE
# customers can be hot, whatever the data size: that bounds what is broadcast.
HOT_SHARE = 0.00001
HOT_FLOOR = 50_000

SLICE = ["__p", "__k"]


def hot_customers(orders: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Customers above HOT_SHARE of the orders: never more than 100,000 rows."""
    counts = orders.groupBy("CustomerId").agg(F.count(F.lit(1)).alias("__n"))
    every = orders.agg(F.count(F.lit(1)).alias("n")).scalar()
    limit = F.greatest(F.lit(floor), every * F.lit(HOT_SHARE))
    return counts.filter(F.col("__n") > limit).select("CustomerId", F.lit(True).alias("__hot"))


def _instant(stamp: str) -> Column:
    """Microseconds since 1970 of a local time, the same on every day of the year."""
    t = F.col(stamp)
    seconds = F.unix_date(t.cast("date")).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.expr(f"extract(SECOND FROM {stamp})") * 1_000_000).cast("bigint")


def with_slices(orders: DataFrame, floor: int = HOT_FLOOR) -> DataFrame | None:
    """Add SLICE, which cuts the orders of hot customers in order of (OrderDateTime, OrderId); NULL for all others.

    Cuts are quantiles of the hot customers' order times; orders at one instant
    are cut by id.  So a customer may have any share of the orders, also on one
    day or at one moment.  Nothing is hot: None.
    """
    hot = materialize(hot_customers(orders.select("CustomerId"), floor))
    if hot.isEmpty():
        return None
    marked = orders.join(F.broadcast(hot), "CustomerId", "left").withColumn("__instant", _instant("OrderDateTime"))
    times = materialize(marked.filter("__hot").select("__instant", "OrderId"))
    time_cuts, id_cuts = cut_points(times, ["__instant", "OrderId"], max(floor, 1))
    placed = with_places(marked, "__instant", "OrderId", time_cuts, id_cuts, ("__p", "__k"))
    cut = {c: F.when(F.col("__hot"), F.col(c)) for c in SLICE}
    return placed.withColumns(cut).drop("__hot", "__instant")


def _slice_totals(sliced: DataFrame, valid: Column) -> DataFrame:
    """One row per hot customer and slice, with what came before and the dates next to it."""
    order = F.struct("OrderDateTime", "OrderId")
    slices = (
        sliced.filter(F.col("__p").isNotNull())
        .groupBy("CustomerId", *SLICE)
        .agg(
            F.count(F.when(valid, F.lit(1))).alias("__n"),
            F.min_by("OrderDate", order).alias("__first"),
            F.max_by("OrderDate", order).alias("__last"),
        )
    )
    ordered = Window.partitionBy("CustomerId").orderBy(*SLICE)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return slices.select(
        "CustomerId",
        *[F.col(c).alias(f"{c}_of") for c in SLICE],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.lag("__last").over(ordered).alias("__previous"),
        F.lead("__first").over(ordered).alias("__next"),
    )


def _with_totals(numbered: DataFrame, sliced: DataFrame, valid: Column) -> DataFrame:
    totals = _slice_totals(sliced, valid)
    return numbered.join(
        totals.withColumnRenamed("CustomerId", "__customer"),
        (F.col("CustomerId") == F.col("__customer")) & (F.col("__p") == F.col("__p_of")) & (F.col("__k") == F.col("__k_of")),
        "left",
    )


def number_orders(
    orders: DataFrame, valid: Column, name: str = "CustomerOrderNumber", floor: int = HOT_FLOOR
) -> DataFrame:
    """Running count of valid orders per customer, by (OrderDateTime, OrderId).

    A cancelled order carries the number reached so far.
    """
    columns = orders.columns
    sliced = with_slices(orders, floor)
    counted = F.sum(F.when(valid, 1).otherwise(0))
    keys = ["CustomerId"] if sliced is None else ["CustomerId", *SLICE]
    running = (
        Window.partitionBy(*keys)
        .orderBy("OrderDateTime", "OrderId")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if sliced is None:
        return orders.withColumn(name, counted.over(running))
    numbered = _with_totals(sliced.withColumn("__number", counted.over(running)), sliced, valid)
    total = F.col("__number") + F.coalesce(F.col("__offset"), F.lit(0))
    return numbered.select(*columns, total.alias(name))


def neighbour_dates(orders: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Add PreviousOrderDate and NextOrderDate of the same customer."""
    columns = orders.columns
    sliced = with_slices(orders, floor)
    keys = ["CustomerId"] if sliced is None else ["CustomerId", *SLICE]
    order = Window.partitionBy(*keys).orderBy("OrderDateTime", "OrderId")
    before, after = F.lag("OrderDate").over(order), F.lead("OrderDate").over(order)
    if sliced is None:
        return orders.withColumns({"PreviousOrderDate": before, "NextOrderDate": after})
    near = _with_totals(sliced.withColumns({"__lag": before, "__lead": after}), sliced, F.lit(True))
    return near.select(
        *columns,
        F.coalesce("__lag", "__previous").alias("PreviousOrderDate"),
        F.coalesce("__lead", "__next").alias("NextOrderDate"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    """The first order of each customer, as a plain aggregate.

    The caller passes the orders that count.  Partial aggregation leaves one
    candidate per customer and task before the shuffle, so no customer is hot.
    """
    first = F.min(F.struct("OrderDateTime", "OrderId")).alias("__first")
    return (
        orders.groupBy("CustomerId")
        .agg(first)
        .select(
            "CustomerId",
            F.col("__first.OrderId").alias("OrderId"),
            F.col("__first.OrderDateTime").alias("OrderDateTime"),
        )
    )
