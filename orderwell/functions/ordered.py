"""Exact global ranks, n-tiles and running sums without a single-task window.

A window with no PARTITION BY (or one over a handful of groups) moves every row
into one task.  Here the value range is cut at approximate quantiles, the window
runs inside each slice, and small per-slice totals are added as offsets.

* The slice of a row depends on its value only, so a recomputed task puts it in
  the same slice again.  The number of slices follows the rows.
* A value that is itself a cut point gets a slice of its own.  Such a value may
  be held by any share of the rows, so its slice is cut again by the tiebreak
  key, into as many parts as its share asks for; all its rows are ties, hence
  that second cut keeps the order too.
* NULL values come first ascending and last descending, as in a plain window.
  They are ties too: one slice, cut again by the key.
* The cut points steer balance only.  Results do not depend on their accuracy.
* The input is read once per ordering and once for the cut points, so it is
  written to the shared folder first and never computed twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions.slices import ROWS_PER_SLICE, cut_points, with_places
from orderwell.session import materialize


@dataclass(frozen=True)
class Ordering:
    """One global order and the columns to derive from it.

    ``value`` is numeric and may be NULL.  Ties follow the key, ascending.
    """

    value: str
    descending: bool = False
    row_number: str | None = None
    rank: str | None = None
    dense_rank: str | None = None
    running_sums: Mapping[str, str] = field(default_factory=dict)
    ntiles: Mapping[str, int] = field(default_factory=dict)
    total: str | None = None


def ntile_of(row_number: Column, rows: Column, tiles: int) -> Column:
    """The n-tile of a row number: the first ``rows % tiles`` tiles get one more row."""
    size = F.floor(rows / F.lit(tiles))
    longer = rows % F.lit(tiles)
    edge = longer * (size + 1)
    inside = F.floor((row_number - 1) / (size + 1)) + 1
    beyond = longer + F.floor((row_number - 1 - edge) / F.greatest(size, F.lit(1))) + 1
    return F.when(row_number <= edge, inside).otherwise(beyond).cast("int")


def order_globally(
    df: DataFrame,
    key: str,
    orderings: Sequence[Ordering],
    group: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add the columns asked for by each ordering, optionally within ``group``.

    ``key`` is a unique numeric column.  With a group, rows are ordered inside
    each of its values; a group may hold any share of the rows.
    """
    columns = list(df.columns)
    df = materialize(df)
    key_cuts, *value_cuts = cut_points(
        df, [key, *[o.value for o in orderings]], rows_per_slice
    )
    sliced = df
    for i, (ordering, cuts) in enumerate(zip(orderings, value_cuts)):
        sliced = with_places(sliced, ordering.value, key, cuts, key_cuts, (f"__p{i}", f"__k{i}"))
        if ordering.descending:
            sliced = sliced.withColumn(f"__p{i}", -F.col(f"__p{i}"))

    result = sliced
    for i, ordering in enumerate(orderings):
        result = _apply(result, sliced, i, ordering, key, group)
        columns += _outputs(ordering)
    return result.select(*columns)


def _outputs(ordering: Ordering) -> list[str]:
    names = [ordering.row_number, ordering.rank, ordering.dense_rank, ordering.total]
    return [n for n in names if n] + list(ordering.running_sums) + list(ordering.ntiles)


def _apply(
    df: DataFrame, source: DataFrame, i: int, ordering: Ordering, key: str, group: str | None
) -> DataFrame:
    place = [f"__p{i}", f"__k{i}"]
    keys = ([group] if group else []) + place
    groups = [F.col(group)] if group else [F.lit(0)]
    sums = ordering.running_sums

    # Slice totals: one row per group and slice.
    if ordering.dense_rank:
        per_value = source.groupBy(*keys, ordering.value).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.sum(c).alias(f"__s_{name}") for name, c in sums.items()],
        )
        totals = per_value.groupBy(*keys).agg(
            F.sum("__n").alias("__n"),
            F.count(F.lit(1)).alias("__d"),
            *[F.sum(f"__s_{name}").alias(f"__s_{name}") for name in sums],
        )
    else:
        totals = source.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__n"),
            F.lit(0).alias("__d"),
            *[F.sum(c).alias(f"__s_{name}") for name, c in sums.items()],
        )

    before = Window.partitionBy(*groups).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    same_position = Window.partitionBy(*groups, F.col(f"__p{i}"))
    # Of the key slices of one value only the first holds a new distinct value.
    first_slice = F.row_number().over(same_position.orderBy(f"__k{i}")) == 1
    earlier = totals.withColumn("__d", F.when(first_slice, F.col("__d")).otherwise(0)).select(
        *keys,
        "__n",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum("__d").over(before), F.lit(0)).alias("__distinct"),
        *[F.sum(f"__s_{m}").over(before).alias(f"__b_{m}") for m in sums],
    )
    offsets = earlier.select(
        *keys,
        "__rows",
        F.min("__rows").over(same_position).alias("__rows_position"),
        F.min("__distinct").over(same_position).alias("__distinct_position"),
        F.sum("__n").over(Window.partitionBy(*groups)).alias("__total"),
        *[f"__b_{m}" for m in sums],
    )
    value = F.col(ordering.value).desc() if ordering.descending else F.col(ordering.value).asc()
    local = Window.partitionBy(*keys).orderBy(value, F.col(key).asc())
    ties = Window.partitionBy(*keys).orderBy(value)
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    numbers = {"__row": F.row_number().over(local)}
    if ordering.rank:
        numbers["__rank"] = F.rank().over(ties)
    if ordering.dense_rank:
        numbers["__dense"] = F.dense_rank().over(ties)
    numbers.update({f"__r_{name}": F.sum(c).over(running) for name, c in sums.items()})
    ranked = df.withColumns(numbers)

    if group:
        # eqNullSafe keeps rows whose group is NULL.
        left, right = ranked, offsets.withColumnsRenamed({k: f"__o_{k}" for k in keys})
        condition = F.lit(True)
        for k in keys:
            condition = condition & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
        joined = left.join(right, condition).drop(*[f"__o_{k}" for k in keys])
    else:
        joined = ranked.join(offsets, place)

    position = F.col("__rows") + F.col("__row")
    out: dict[str, Column] = {}
    if ordering.row_number:
        out[ordering.row_number] = position.cast("bigint")
    if ordering.rank:
        out[ordering.rank] = (F.col("__rows_position") + F.col("__rank")).cast("bigint")
    if ordering.dense_rank:
        out[ordering.dense_rank] = (F.col("__distinct_position") + F.col("__dense")).cast("bigint")
    if ordering.total:
        out[ordering.total] = F.col("__total").cast("bigint")
    for name in sums:
        offset, inside = F.col(f"__b_{name}"), F.col(f"__r_{name}")
        # NULL only where no value came before
        out[name] = F.coalesce(offset + inside, offset, inside)
    for name, tiles in ordering.ntiles.items():
        out[name] = ntile_of(position, F.col("__total"), tiles)
    kept = [c for c in df.columns if c not in place]
    return joined.select(*kept, *[column.alias(name) for name, column in out.items()])
