"""Argument checks made before a plan is built (and the few that must look at data)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAST_DATE = dt.date(9999, 12, 31)


def as_date(value: dt.date | str | None, name: str) -> dt.date:
    if value is None:
        raise ValueError(f"{name} is required")
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def date_range(start: dt.date | str | None, end: dt.date | str | None) -> tuple[dt.date, dt.date]:
    """An inclusive range; the end needs a following day, so the last date is refused."""
    first, last = as_date(start, "start"), as_date(end, "end")
    if first > last:
        raise ValueError("start must not be after end")
    if last == LAST_DATE:
        raise ValueError("end must be earlier than 9999-12-31")
    return first, last


def between(value: int, low: int, high: int, name: str) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")
    return value


def at_least(value: int, low: int, name: str) -> int:
    if value < low:
        raise ValueError(f"{name} must be at least {low}")
    return value


def must_exist(df: DataFrame, column: str, value: object, name: str) -> None:
    """One pushed-down lookup that stops at the first match."""
    if df.filter(F.col(column) == F.lit(value)).select(F.lit(1)).limit(1).isEmpty():
        raise ValueError(f"{name} {value!r} does not exist")


def in_range(column: str, first: dt.date, last: dt.date):
    """Half-open filter on the bare column, so that it reaches the file scan."""
    after = last + dt.timedelta(days=1)
    lower = F.lit(first).cast("timestamp_ntz")
    upper = F.lit(after).cast("timestamp_ntz")
    return (F.col(column) >= lower) & (F.col(column) < upper)
