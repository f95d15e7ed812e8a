"""Value slices of roughly equal size, cut at approximate quantiles.

The number of slices follows the rows: one per ROWS_PER_SLICE, without an upper
limit.  The slice of a value is looked up in the sorted array of cuts, which is
one literal of the plan, so a recomputed task puts a row in the same slice again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

# A slice is one task's share: its size is fixed and its number grows with the data.
ROWS_PER_SLICE = 250_000
ACCURACY = 2_000


@dataclass(frozen=True)
class Cuts:
    """Distinct ascending cuts of a column.

    ``shares`` says how many of the evenly spaced quantiles fell on each cut: a
    value with a share of more than one holds that many slices of rows.
    ``null_share`` is the same for NULL.
    """

    values: tuple
    shares: tuple[int, ...]
    null_share: int
    kind: DataType

    def array(self) -> Column:
        return F.split(F.lit(",".join(map(_text, self.values))), ",").cast(ArrayType(self.kind))

    def share_array(self) -> Column:
        return F.split(F.lit(",".join(map(str, self.shares))), ",").cast("array<int>")


def _text(value) -> str:
    if isinstance(value, Decimal):
        return f"{value:f}"
    return repr(value) if isinstance(value, float) else str(value)


def cut_points(
    df: DataFrame, columns: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> list[Cuts]:
    """Cuts per column, by a count and one aggregate pass.

    What reaches the driver is one number per slice, not per row.
    """
    rows = df.count()
    slices = max(2, -(-rows // rows_per_slice))
    shares = [i / slices for i in range(1, slices)]
    accuracy = max(ACCURACY, 8 * slices)
    found = df.agg(
        *[F.percentile_approx(c, shares, accuracy).alias(f"c{i}") for i, c in enumerate(columns)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    out = []
    for i, c in enumerate(columns):
        runs = [(value, len(list(same))) for value, same in groupby(sorted(found[f"c{i}"] or []))]
        missing = -(-(rows - found[f"n{i}"]) // rows_per_slice)
        kind = df.schema[c].dataType
        out.append(Cuts(tuple(v for v, _ in runs), tuple(n for _, n in runs), missing, kind))
    return out


def slice_of(column: str, cuts: Cuts) -> Column:
    """How many cuts lie below the value, by halving steps over the sorted array; 0 for NULL."""
    if not cuts.values:
        return F.lit(0)
    array, steps = cuts.array(), [2**i for i in reversed(range(len(cuts.values).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        return at + F.when(F.get(array, at + step - 1) < F.col(column), step).otherwise(0)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def with_places(
    df: DataFrame, value: str, key: str, value_cuts: Cuts, key_cuts: Cuts, names: tuple[str, str]
) -> DataFrame:
    """Add two columns that order the slices of (value, key): the value's place, and a part of the value by key.

    A value that is itself a cut gets a place of its own.  Its rows are ties, so
    they can be cut again by the key, into as many parts as the value holds
    slices; NULL likewise, whose place is the lowest.  Places therefore number
    about twice the slices, however the rows are spread.
    """
    at, part = f"{names[0]}_at", f"{names[1]}_at"
    found = df.withColumns({at: slice_of(value, value_cuts), part: slice_of(key, key_cuts)})
    missing = F.col(value).isNull()
    if value_cuts.values:
        on_cut = F.coalesce(F.get(value_cuts.array(), F.col(at)) == F.col(value), F.lit(False))
        share = F.get(value_cuts.share_array(), F.col(at))
    else:
        on_cut, share = F.lit(False), F.lit(1)
    share = F.when(missing, value_cuts.null_share).otherwise(share)
    place = F.when(missing, -1).otherwise(F.col(at) * 2 + on_cut.cast("int"))
    inside = F.floor(F.col(part) * share / (len(key_cuts.values) + 1)).cast("int")
    return found.withColumns(
        {names[0]: place, names[1]: F.when(missing | on_cut, inside).otherwise(0)}
    ).drop(at, part)
