"""Exact interpolated quantiles of a whole column, computed on all tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions.slices import ROWS_PER_SLICE, cut_points, slice_of


def exact_quantiles(
    df: DataFrame, column: str, shares: Sequence[float], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """One row with columns q0, q1, ...: linear interpolation between ranks.

    Values are counted first, so copies shrink before the shuffle; running
    counts are taken inside value slices and shifted by the slices before.
    """
    values = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    (cuts,) = cut_points(values, ["v"], rows_per_slice)
    sliced = counts.withColumn("s", slice_of("v", cuts))
    per_slice = sliced.groupBy("s").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        "s",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    up_to = Window.partitionBy("s").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        sliced.withColumn("c", F.sum("n").over(up_to))
        .join(offsets, "s")
        .select("v", "total", (F.col("offset") + F.col("c")).alias("last"), "n")
        .withColumn("first", F.col("last") - F.col("n"))  # 0-based rank of the first copy
    )
    picks = []
    for i, share in enumerate(shares):
        place = (F.col("total") - 1) * F.lit(float(share))
        for name, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            held = (F.col("first") <= rank) & (rank < F.col("last"))
            picks.append(F.max(F.when(held, F.col("v"))).cast("double").alias(f"{name}{i}"))
    row = ranked.agg(F.max("total").alias("total"), *picks)
    out = []
    for i, share in enumerate(shares):
        place = (F.col("total") - 1) * F.lit(float(share))
        part = place - F.floor(place)
        out.append((F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * part).alias(f"q{i}"))
    return row.select(*out)
