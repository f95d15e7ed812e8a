"""Filter contexts: what a measure does to the filters of the cell it is asked in, before it is added up.

A measure is a tree.  Its leaves are base aggregates of one fact.  Inner nodes
either compute with the values below them (``Ratio``, ``Change``) or change the
context the leaves are evaluated in (``Shift``, ``ToDate``, ``Trailing``,
``Span``, ``Without``).  Changes are pushed down to the leaves, outermost first,
so all measures of a fact compile to one grouped aggregate.

A change of dates works on a small table (cell, date): the dates each cell
holds, marked by the context.  Facts meet it after they were added up by day, so
a day that belongs to many cells (a year to date by day) repeats totals and
never fact rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "FullDate"


@dataclass(frozen=True)
class Base:
    """A base aggregate by name, in the context it is met in."""

    name: str


@dataclass(frozen=True)
class Ratio:
    top: Node
    bottom: Node


@dataclass(frozen=True)
class Change:
    """Difference with blanks as zero, blank only where both are."""

    now: Node
    before: Node


@dataclass(frozen=True)
class Shift:
    """The same dates, a number of months earlier.

    A month's last day stands for all later days of a longer month, so whole
    months move to whole months.
    """

    of: Node
    months: int

    def dates(self, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
        day = F.col(DAY)
        moved = F.add_months(day, -self.months)
        until = F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)
        return cells.select(*keys, F.explode(F.sequence(moved, until)).alias(DAY)).distinct()


@dataclass(frozen=True)
class ToDate:
    """From the beginning of the last date's month or year to that date."""

    of: Node
    unit: str  # "month" or "year"

    def dates(self, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
        last = F.max(DAY)
        return _between(cells, keys, F.trunc(last, self.unit), last)


@dataclass(frozen=True)
class Trailing:
    """The months that end with the last date; whole months where it ends one."""

    of: Node
    months: int

    def dates(self, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
        last = F.max(DAY)
        whole = F.trunc(F.add_months(last, 1 - self.months), "MM")
        part = F.date_add(F.add_months(last, -self.months), 1)
        return _between(cells, keys, F.when(last == F.last_day(last), whole).otherwise(part), last)


@dataclass(frozen=True)
class Span:
    """All days from the first date to the last."""

    of: Node

    def dates(self, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
        return _between(cells, keys, F.min(DAY), F.max(DAY))


@dataclass(frozen=True)
class Without:
    """Neither grouped nor filtered by one column."""

    of: Node
    table: str
    column: str


@dataclass(frozen=True)
class Place:
    """A value read off the descending order of a measure over the members of one key.

    ``what`` is rank (dense), running (the sum over as many members as the rank
    says), share (of the running sum in the total) or flag (share up to a limit).
    """

    of: Base
    key: str
    what: str
    limit: float = 0.80


Node = Base | Ratio | Change | Shift | ToDate | Trailing | Span | Without | Place
DATED = Shift | ToDate | Trailing | Span


@dataclass(frozen=True)
class Leaf:
    """A base aggregate and the changes of context on the way to it, outermost first."""

    base: str
    changes: tuple = ()

    @property
    def dated(self) -> tuple:
        return tuple(c for c in self.changes if not isinstance(c, Without))

    @property
    def without(self) -> frozenset[tuple[str, str]]:
        return frozenset((c.table, c.column) for c in self.changes if isinstance(c, Without))

    @property
    def column(self) -> str:
        return "|".join([self.base, *[_label(c) for c in self.changes]])


def _label(change: Node) -> str:
    settings = [str(v) for k, v in vars(change).items() if k != "of"]
    return " ".join([type(change).__name__, *settings])


def _between(cells: DataFrame, keys: Sequence[str], first, last) -> DataFrame:
    """Every day of an interval per cell; a context without dates stays without."""
    bounds = cells.groupBy(*keys).agg(first.alias("__first"), last.alias("__last")).where("__last IS NOT NULL")
    return bounds.select(*keys, F.explode(F.sequence("__first", "__last")).alias(DAY))


def lowered(node: Node, changes: tuple = ()) -> Node | Leaf:
    """The tree with every change of context moved into its leaves."""
    match node:
        case Base(name):
            return Leaf(name, changes)
        case Ratio(top, bottom):
            return Ratio(lowered(top, changes), lowered(bottom, changes))
        case Change(now, before):
            return Change(lowered(now, changes), lowered(before, changes))
        case Place(of, key, what, limit):
            return Place(lowered(of, changes), key, what, limit)
        case _:
            return lowered(node.of, (*changes, node))


def leaves(node: Node | Leaf) -> Iterator[Leaf]:
    """The leaves of a lowered tree."""
    match node:
        case Leaf():
            yield node
        case Ratio(a, b) | Change(a, b):
            yield from leaves(a)
            yield from leaves(b)
        case Place(of):
            yield from leaves(of)


def places(node: Node | Leaf) -> Iterator[Place]:
    match node:
        case Place():
            yield node
        case Ratio(a, b) | Change(a, b):
            yield from places(a)
            yield from places(b)


def cell_dates(
    calendar: DataFrame, keys: Sequence[str], changes: Sequence[DATED]
) -> DataFrame:
    """(keys, FullDate) after the changes; ``calendar`` holds the dates in context with their keys."""
    cells = calendar.select(*keys, DAY).distinct()
    for change in changes:
        cells = change.dates(cells, keys)
    return cells
