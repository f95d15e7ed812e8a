"""Column expressions shared by all operators.  All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: ColumnLike, precision: int = 14) -> Column:
    return _col(value).cast(f"decimal({precision},2)")


def times(quantity: ColumnLike, amount: ColumnLike) -> Column:
    """Quantity times a decimal(12,2) amount.

    A quantity is a two-byte number, so five digits hold it and the product
    stays within the 18 digits that fit a machine word.
    """
    return _col(quantity).cast("decimal(5,0)") * _col(amount)


def sum_money(amount: ColumnLike) -> Column:
    """Exact sum of decimal(14,2) amounts, carried as whole cents in a bigint.

    A decimal sum buffers more than 18 digits and leaves the fast path on every
    row.  A total past the bigint range raises an error; it never wraps.
    """
    cents = (money(amount) * F.lit(100).cast("decimal(3,0)")).cast("bigint")
    total = F.sum(cents).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(3,2)")
    return total.cast("decimal(18,2)")


def zero_if_null(value: ColumnLike) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Safe division: a zero or missing denominator gives NULL, never an error.

    Both sides are exact (integer or decimal) up to this single division.
    """
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def growth_pct(current: ColumnLike, previous: ColumnLike) -> Column:
    """Change against a previous value, in percent."""
    return (ratio(current, previous) - F.lit(1.0)) * F.lit(100.0)


def round_cents(value: ColumnLike) -> Column:
    """Round a double half up to whole cents and return it as a decimal."""
    cents = F.floor(_col(value) * F.lit(100.0) + F.lit(0.5)).cast("decimal(18,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def month_start(value: ColumnLike) -> Column:
    return F.trunc(_col(value), "MM")


def month_index(value: ColumnLike) -> Column:
    """Months since year 0; differences count calendar boundaries."""
    return F.year(_col(value)) * F.lit(12) + F.month(_col(value))


def month_diff(later: ColumnLike, earlier: ColumnLike) -> Column:
    return month_index(later) - month_index(earlier)


def date_key(value: ColumnLike) -> Column:
    """yyyymmdd as an integer, by arithmetic rather than string formatting."""
    day = _col(value)
    return F.year(day) * F.lit(10000) + F.month(day) * F.lit(100) + F.dayofmonth(day)


def count_if(condition: Column) -> Column:
    """Number of rows meeting a condition, 0 rather than NULL on no rows."""
    return F.count(F.when(condition, F.lit(1)))
