"""Governed measures over the star schema, evaluated as grouped aggregates.

``evaluate`` joins the dimensions asked for to each fact that a measure needs,
aggregates every fact on its own, and only then joins the small results on the
group keys.  Facts are never joined to facts.  Filters on a dimension reach the
facts related to it and leave the others alone.  Measures that change their
filter context (other periods, removed filters, ranks) are trees of
``plans.contexts``; they are asked for by name like all others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import ratio
from orderwell.functions.ordered import Ordering, order_globally
from orderwell.functions.scalars import count_if
from orderwell.operators.customers import AT_RISK_STATUSES
from orderwell.functions.scalars import date_key, month_index
from orderwell.operators.facts import CANCELLED, REJECTED
from orderwell.plans.contexts import (
    DAY, Base, Change, Leaf, Node, Place, Ratio, Shift, Span, ToDate, Trailing, Without, cell_dates, leaves, lowered,
    places,
)
from orderwell.plans.star import RELATIONSHIPS, Star

GroupKey = tuple[str, str]

#: A table and a condition on its columns.  A third part names the one column
#: the condition is about, so that a measure can take the filter away.
Filter = tuple[str, Column] | tuple[str, Column, str]


@dataclass(frozen=True)
class Measure:
    """An aggregate of one fact.  ``item`` is what a distinct count counts; all others add up over parts of the fact."""

    fact: str
    value: Callable[[], Column]
    item: Callable[[], Column] | None = None
    additive: bool = True


def _sum(fact: str, column: str, where: Callable[[], Column] | None = None) -> Measure:
    def value() -> Column:
        return F.sum(F.col(column) if where is None else F.when(where(), F.col(column)))

    return Measure(fact, value)


def _count(fact: str, where: Callable[[], Column] | None = None) -> Measure:
    """A row count; no rows give NULL, as a blank measure does."""

    def value() -> Column:
        counted = F.count(F.lit(1)) if where is None else count_if(where())
        return F.nullif(counted, F.lit(0))

    return Measure(fact, value)


def _distinct(fact: str, column: str, where: Callable[[], Column]) -> Measure:
    def item() -> Column:
        return F.when(where(), F.col(column))

    return Measure(fact, lambda: F.nullif(F.count_distinct(item()), F.lit(0)), item, additive=False)


def _one_cell() -> Column:
    """Retention of exactly one cohort in exactly one month, else blank."""
    one = (F.count_distinct("CohortMonth") == 1) & (F.count_distinct("MonthsSinceFirstOrder") == 1)
    return F.when(one, ratio(F.sum("ActiveCustomers"), F.max("CohortSize")))


def _valid() -> Column:
    return F.col("StatusName") != CANCELLED


def _repeat() -> Column:
    return _valid() & (F.col("IsRepeatPurchase") == 1)


def _delivered() -> Column:
    return _valid() & F.col("DeliveredDate").isNotNull()


def _on_time() -> Column:
    return _valid() & (F.col("IsOnTime") == 1)


def _late() -> Column:
    return _delivered() & (F.col("IsOnTime") == 0)


def _sold() -> Column:
    return F.col("IsValidOrder") == 1


def _accepted() -> Column:
    return F.col("ReturnStatus") != REJECTED


def _buyers() -> Column:
    return F.col("LifetimeOrders") > 0


def _at_risk() -> Column:
    return F.col("LifecycleStatus").isin(*AT_RISK_STATUSES)


ORDERS, LINES, RETURNS = "FactOrders", "FactOrderLines", "FactReturns"
REVIEWS, CAMPAIGNS, CUSTOMER = "FactReviews", "FactCampaignPerformance", "DimCustomer"
COHORTS, RFM = "FactCohortRetention", "FactRfmSnapshot"

# Customers by the day of their first order: DimCustomer in the role of a fact.
FIRST = "FirstOrders"
OWN_TABLE = {FIRST: CUSTOMER}

# An order is one FactOrders row, so counting rows counts distinct orders.
BASE: dict[str, Measure] = {
    "Revenue": _sum(ORDERS, "NetRevenue"),
    "Revenue After Refund": _sum(ORDERS, "RevenueAfterRefund"),
    "Gross Revenue": _sum(ORDERS, "GrossRevenue"),
    "Discount Amount": _sum(ORDERS, "DiscountAmount"),
    "Refund Amount": _sum(ORDERS, "RefundAmount"),
    "Gross Profit": _sum(ORDERS, "GrossProfit"),
    "Gross Profit After Refund": _sum(ORDERS, "GrossProfitAfterRefund"),
    "Orders": _count(ORDERS, _valid),
    "All Orders": _count(ORDERS),
    "Cancelled Orders": _count(ORDERS, lambda: F.col("StatusName") == CANCELLED),
    "Repeat Orders": _count(ORDERS, _repeat),
    "Promotion Orders": _count(ORDERS, lambda: _valid() & F.col("PromotionId").isNotNull()),
    "Delivered Orders": _count(ORDERS, _delivered),
    "On-Time Deliveries": _count(ORDERS, _on_time),
    "Late Deliveries": _count(ORDERS, _late),
    "Active Customers": _distinct(ORDERS, "CustomerId", _valid),
    "Repeat Customers": _distinct(ORDERS, "CustomerId", _repeat),
    "Delivery Days Total": _sum(
        ORDERS, "DeliveryDays", lambda: F.col("DeliveredDate").isNotNull()
    ),
    "Delivery Days Count": _count(ORDERS, lambda: F.col("DeliveryDays").isNotNull()),
    "Units Sold": _sum(LINES, "Quantity", _sold),
    "Product Revenue": _sum(LINES, "NetRevenue"),
    "Product Gross Profit": _sum(LINES, "GrossProfit"),
    "Returned Units": _sum(LINES, "ReturnedQuantity", _sold),
    "Product Refund Amount": _sum(LINES, "RefundAmount", _sold),
    "Return Event Units": _sum(RETURNS, "ReturnQuantity", _accepted),
    "Return Refund Amount": _sum(RETURNS, "RefundAmount", _accepted),
    "Reviews": _count(REVIEWS),
    "Rating Total": _sum(REVIEWS, "Rating"),
    "Verified Reviews": _count(REVIEWS, lambda: F.col("IsVerifiedPurchase") == 1),
    "Returned Reviews": _count(REVIEWS, lambda: F.col("WasReturned") == 1),
    "One and Two Star Reviews": _count(REVIEWS, lambda: F.col("Rating") <= 2),
    "Campaign Audience": _sum(CAMPAIGNS, "Audience"),
    "Campaign Clicks": _sum(CAMPAIGNS, "Clicks"),
    "Campaign Conversions": _sum(CAMPAIGNS, "Conversions"),
    "Attributed Orders": _sum(CAMPAIGNS, "AttributedOrders"),
    "Attributed Revenue": _sum(CAMPAIGNS, "AttributedRevenueAfterRefund"),
    "Attributed Gross Profit": _sum(CAMPAIGNS, "AttributedGrossProfit"),
    "Campaign Discount Cost": _sum(CAMPAIGNS, "DiscountCost"),
    "Buyer Count": _count(CUSTOMER, _buyers),
    "Buyer Lifetime Revenue": _sum(CUSTOMER, "LifetimeRevenueAfterRefund", _buyers),
    "Buyer Projected Revenue": _sum(CUSTOMER, "Projected12MonthRevenue", _buyers),
    "Customers at Risk": _count(CUSTOMER, _at_risk),
    "Revenue at Risk": _sum(CUSTOMER, "LifetimeRevenueAfterRefund", _at_risk),
    "RFM Customers": _distinct(RFM, "CustomerId", lambda: F.lit(True)),
    "RFM Monetary Value": _sum(RFM, "MonetaryValue"),
    "First Orders": _count(FIRST),
    "Retention %": Measure(COHORTS, _one_cell, additive=False),
}

# Columns that cost a join of their own; all others come with the fact.
JOINED_COLUMNS: dict[str, set[str]] = {
    "Repeat Orders": {"IsRepeatPurchase"},
    "Repeat Customers": {"IsRepeatPurchase"},
    "Delivered Orders": {"DeliveredDate"},
    "On-Time Deliveries": {"IsOnTime"},
    "Late Deliveries": {"DeliveredDate", "IsOnTime"},
    "Delivery Days Total": {"DeliveredDate", "DeliveryDays"},
    "Delivery Days Count": {"DeliveryDays"},
    "Returned Reviews": {"WasReturned"},
}

RATIOS: dict[str, tuple[str, str]] = {
    "Gross Margin %": ("Gross Profit", "Revenue"),
    "Gross Margin After Refund %": ("Gross Profit After Refund", "Revenue After Refund"),
    "Discount Rate": ("Discount Amount", "Gross Revenue"),
    "Refund Rate": ("Refund Amount", "Revenue"),
    "Repeat Order Rate": ("Repeat Orders", "Orders"),
    "Average Order Value": ("Revenue", "Orders"),
    "Revenue per Active Customer": ("Revenue After Refund", "Active Customers"),
    "Average Historical CLV": ("Buyer Lifetime Revenue", "Buyer Count"),
    "Projected 12M Customer Value": ("Buyer Projected Revenue", "Buyer Count"),
    "Churn Indicator %": ("Customers at Risk", "Buyer Count"),
    "Product Gross Margin %": ("Product Gross Profit", "Product Revenue"),
    "Return Rate": ("Returned Units", "Units Sold"),
    "On-Time Delivery %": ("On-Time Deliveries", "Delivered Orders"),
    "Average Delivery Days": ("Delivery Days Total", "Delivery Days Count"),
    "Late Delivery %": ("Late Deliveries", "Delivered Orders"),
    "Average Rating": ("Rating Total", "Reviews"),
    "Verified Review %": ("Verified Reviews", "Reviews"),
    "Reviewed Item Return Rate": ("Returned Reviews", "Reviews"),
    "Low Rating Review %": ("One and Two Star Reviews", "Reviews"),
    "Campaign Conversion %": ("Campaign Conversions", "Campaign Clicks"),
    "Campaign CTR %": ("Campaign Clicks", "Campaign Audience"),
    "Attributed Revenue per Discount Dollar": ("Attributed Revenue", "Campaign Discount Cost"),
    "Attributed Average Order Value": ("Attributed Revenue", "Attributed Orders"),
    "Campaign Profit per Conversion": ("Attributed Gross Profit", "Campaign Conversions"),
    "Cancellation Rate": ("Cancelled Orders", "All Orders"),
    "Promotion Order Rate": ("Promotion Orders", "Orders"),
}



def _earlier(measure: str, months: int) -> Node:
    return Shift(tree(measure), months)


def _growth(measure: str, months: int) -> Ratio:
    return Ratio(Change(tree(measure), _earlier(measure, months)), _earlier(measure, months))


def tree(name: str) -> Node:
    """The tree of a measure by its name."""
    if name in CONTEXTUAL:
        return CONTEXTUAL[name]()
    if name in RATIOS:
        top, bottom = RATIOS[name]
        return Ratio(Base(top), Base(bottom))
    if name in BASE:
        return Base(name)
    raise ValueError(f"unknown measure {name!r}")


def _customer(what: str) -> Place:
    return Place(Base("Revenue After Refund"), "CustomerId", what)


# Measures that change the filter context of their cell.
CONTEXTUAL: dict[str, Callable[[], Node]] = {
    "New Customers": lambda: Span(Base("First Orders")),
    "Revenue Previous Month": lambda: _earlier("Revenue", 1),
    "Revenue MoM Change": lambda: Change(tree("Revenue"), _earlier("Revenue", 1)),
    "Revenue MoM %": lambda: _growth("Revenue", 1),
    "Revenue Previous Year": lambda: _earlier("Revenue", 12),
    "Revenue YoY Change": lambda: Change(tree("Revenue"), _earlier("Revenue", 12)),
    "Revenue YoY %": lambda: _growth("Revenue", 12),
    "Revenue MTD": lambda: ToDate(tree("Revenue"), "month"),
    "Revenue YTD": lambda: ToDate(tree("Revenue"), "year"),
    "Revenue After Refund YTD": lambda: ToDate(tree("Revenue After Refund"), "year"),
    "Rolling 3M Revenue": lambda: Trailing(tree("Revenue"), 3),
    "Rolling 12M Revenue": lambda: Trailing(tree("Revenue"), 12),
    "Orders Previous Year": lambda: _earlier("Orders", 12),
    "Orders YoY %": lambda: _growth("Orders", 12),
    "Gross Profit Previous Year": lambda: _earlier("Gross Profit", 12),
    "Gross Profit YoY %": lambda: _growth("Gross Profit", 12),
    "Active Customer Previous Year": lambda: _earlier("Active Customers", 12),
    "Active Customer YoY %": lambda: _growth("Active Customers", 12),
    "RFM Customer Share %": lambda: Ratio(tree("RFM Customers"), Without(tree("RFM Customers"), RFM, "RfmSegment")),
    "Product Revenue Rank": lambda: Place(Base("Product Revenue"), "ProductId", "rank"),
    "Customer Revenue Rank": lambda: _customer("rank"),
    "Cumulative Customer Revenue": lambda: _customer("running"),
    "Pareto Revenue %": lambda: _customer("share"),
    "Pareto 80% Customer Flag": lambda: _customer("flag"),
}

LINKS = {(fact, dim): (fact_key, dim_key) for fact, fact_key, dim, dim_key in RELATIONSHIPS}
LINKS[(FIRST, "DimDate")] = ("FirstOrderDateKey", "DateKey")


def _with_dimension(
    fact: DataFrame, name: str, dim: str, columns: Sequence[str], star: Mapping[str, DataFrame]
) -> DataFrame:
    fact_key, dim_key = LINKS[(name, dim)]
    picked = star[dim].select(
        F.col(dim_key).alias("__k"), *[F.col(c).alias(f"{dim}.{c}") for c in columns]
    )
    return fact.join(picked, F.col(fact_key) == F.col("__k"), "left").drop("__k")


def _source(
    star: Mapping[str, DataFrame],
    name: str,
    parts: Sequence[str],
    group_by: Sequence[GroupKey],
    filters: Sequence[Filter],
) -> DataFrame:
    """The fact itself, as narrow as the measures, groups and filters allow."""
    if name == FIRST:
        known = star[CUSTOMER].where(F.col("FirstOrderDate").isNotNull())
        return known.withColumn("FirstOrderDateKey", date_key("FirstOrderDate"))
    if not isinstance(star, Star) or any(table == name for table, *_ in filters):
        return star[name]  # a condition on the fact may read any of its columns
    wanted = {c for p in parts for c in JOINED_COLUMNS.get(p, ())}
    wanted |= {column for table, column in group_by if table == name}
    wanted |= {
        LINKS[(name, table)][0] for table, *_ in [*group_by, *filters] if (name, table) in LINKS
    }
    return star.rows(name, wanted)


def _fact_rows(
    star: Mapping[str, DataFrame],
    name: str,
    parts: Sequence[str],
    group_by: Sequence[GroupKey],
    filters: Sequence[Filter],
) -> DataFrame:
    """A fact with its filters applied and ``Table.column`` group keys attached."""
    rows = _source(star, name, parts, group_by, filters)
    own = {name, OWN_TABLE.get(name)}
    for table, condition, *_ in filters:
        if table in own:
            rows = rows.filter(condition)
        elif (name, table) in LINKS:
            fact_key, dim_key = LINKS[(name, table)]
            kept = star[table].filter(condition).select(F.col(dim_key).alias(fact_key))
            rows = rows.join(kept, fact_key, "left_semi")
    wanted: dict[str, list[str]] = {}
    for table, column in group_by:
        if table in own:
            rows = rows.withColumn(f"{table}.{column}", F.col(column))
        elif (name, table) in LINKS:
            wanted.setdefault(table, []).append(column)
        else:
            raise ValueError(f"{table} does not filter {name}")
    for table, columns in wanted.items():
        rows = _with_dimension(rows, name, table, columns, star)
    return rows


def evaluate(
    star: Mapping[str, DataFrame],
    measures: Sequence[str | tuple[str, Node]],
    group_by: Sequence[GroupKey] = (),
    filters: Sequence[Filter] = (),
) -> DataFrame:
    """Measures per group; rows where every measure is blank are left out.

    A measure is a name, or a name of one's own and its tree.  A rank or share
    over customers or products needs their id among the groups; it is taken
    among the members that share the other groups.
    """
    keys = [f"{table}.{column}" for table, column in group_by]
    trees = {m if isinstance(m, str) else m[0]: lowered(tree(m) if isinstance(m, str) else m[1]) for m in measures}
    needed: dict[tuple, list[Leaf]] = {}
    for leaf in dict.fromkeys(x for t in trees.values() for x in leaves(t)):
        needed.setdefault((BASE[leaf.base].fact, leaf.without), []).append(leaf)

    # results on all keys are joined first; those that lost a key are looked up by the rest
    whole, partial = [], []
    for (fact, gone), found in needed.items():
        result, kept = _result(star, fact, gone, found, group_by, filters)
        (whole if kept == keys else partial).append((result, kept))
    if not whole:
        raise ValueError("no measure is evaluated by all of the groups")
    joined = whole[0][0]
    for other, _ in whole[1:]:
        joined = _align(joined, other, keys)
    for other, kept in partial:
        joined = _look_up(joined, other, kept)
    ordered = dict.fromkeys((p.of, p.key) for t in trees.values() for p in places(t))
    for of, key in ordered:
        joined = _order(joined, of, key, keys, group_by)
    return _finish(joined, keys, group_by, trees)


def _result(
    star: Mapping[str, DataFrame],
    fact: str,
    gone: frozenset[GroupKey],
    found: Sequence[Leaf],
    group_by: Sequence[GroupKey],
    filters: Sequence[Filter],
) -> tuple[DataFrame, list[str]]:
    """The leaves of one fact, and the group keys they have."""
    group_by = [g for g in group_by if g not in gone]
    filters = [f for f in filters if len(f) < 3 or (f[0], f[2]) not in gone]
    keys = [f"{table}.{column}" for table, column in group_by]
    names = list(dict.fromkeys(leaf.base for leaf in found))
    if not any(leaf.dated for leaf in found) or (fact, "DimDate") not in LINKS:
        # nothing moves, or dates do not filter this fact
        rows = _fact_rows(star, fact, names, group_by, filters)
        values = [BASE[leaf.base].value().alias(leaf.column) for leaf in found]
        return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*values), keys
    return _by_dates(star, fact, found, names, keys, group_by, filters), keys


def _by_dates(star, fact, found, names, keys, group_by, filters) -> DataFrame:
    """All contexts of a fact at once: its days meet the dates of every cell in every context, marked by context.

    Sums and counts are added up by day before; distinct items are one row per
    day and group.  The fact is read once for the sums and once per distinct count.
    """
    date_columns = [c for table, c in group_by if table == "DimDate"]
    calendar = star["DimDate"]
    for table, condition, *_ in filters:
        calendar = calendar.filter(condition) if table == "DimDate" else calendar
    calendar = calendar.select(*[F.col(c).alias(f"DimDate.{c}") for c in date_columns], DAY)
    contexts = list(dict.fromkeys(leaf.dated for leaf in found))

    def cells(wanted: Sequence[tuple]) -> DataFrame:
        parts = [
            cell_dates(calendar, [f"`DimDate.{c}`" for c in date_columns], context).withColumn("__context", F.lit(contexts.index(context)))
            for context in wanted
        ]
        every = reduce(DataFrame.unionByName, parts)
        # only days of the calendar can be in a context
        return every.join(star["DimDate"].select(DAY), DAY, "left_semi").withColumn("__day", date_key(DAY)).drop(DAY)

    def marked(leaf: Leaf, value: Column) -> Column:
        return F.when(F.col("__context") == contexts.index(leaf.dated), value)

    others = [g for g in group_by if g[0] != "DimDate"]
    rows = _fact_rows(star, fact, names, [*others, ("DimDate", "DateKey")], [f for f in filters if f[0] != "DimDate"])
    rows = rows.withColumnRenamed("DimDate.DateKey", "__day")
    other_keys = [F.col(f"`{table}.{column}`") for table, column in others]
    quoted = [F.col(f"`{k}`") for k in keys]
    results = []
    sums = [leaf for leaf in found if BASE[leaf.base].additive]
    if sums:
        daily = rows.groupBy(*other_keys, "__day").agg(*[BASE[n].value().alias(n) for n in names if BASE[n].additive])
        met = daily.join(cells(list(dict.fromkeys(x.dated for x in sums))), "__day").groupBy(*quoted)
        results.append(met.agg(*[F.sum(marked(x, F.col(f"`{x.base}`"))).alias(x.column) for x in sums]))
    for name in names:
        if BASE[name].additive:
            continue
        if BASE[name].item is None:
            raise ValueError(f"{name} cannot be moved in time")
        own = [leaf for leaf in found if leaf.base == name]
        items = rows.select(*other_keys, "__day", BASE[name].item().alias("__item")).where("__item IS NOT NULL").distinct()
        met = items.join(cells(list(dict.fromkeys(x.dated for x in own))), "__day").groupBy(*quoted)
        counts = [F.nullif(F.count_distinct(marked(x, F.col("__item"))), F.lit(0)).alias(x.column) for x in own]
        results.append(met.agg(*counts))
    return reduce(lambda a, b: _align(a, b, keys), results)


def _look_up(joined: DataFrame, other: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The values of a context with fewer keys, for every row that shares those."""
    if not kept:
        return joined.withColumns({c: other.select(F.col(f"`{c}`")).scalar() for c in other.columns})
    renamed = other.withColumnsRenamed({k: f"__{k}" for k in kept})
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in kept])
    return joined.join(renamed, same, "left").drop(*[f"__{k}" for k in kept])


def _order(
    joined: DataFrame, of: Leaf, key: str, keys: Sequence[str], group_by: Sequence[GroupKey]
) -> DataFrame:
    """Dense rank, running value and total of a measure over the members of a key, within the other groups."""
    at = [k for k, (_, column) in zip(keys, group_by) if column == key]
    if not at:
        raise ValueError(f"{of.base} is ranked over {key}, which is not among the groups")
    others = [k for k in keys if k != at[0]]
    inside = F.struct(*[F.col(f"`{k}`").alias(f"g{i}") for i, k in enumerate(others)]) if others else F.lit(None)
    plain = joined.select(
        F.col(f"`{at[0]}`").alias("member"),
        *([inside.alias("inside")] if others else []),
        F.col(f"`{of.column}`").alias("value"),
    ).where("value IS NOT NULL AND member IS NOT NULL")
    group = "inside" if others else None
    ordering = Ordering("value", descending=True, row_number="place", dense_rank="rank", running_sums={"sum": "value"})
    ranked = order_globally(plain, "member", [ordering], group=group)
    # the rank is used as the number of members to add up
    sums = ranked.select(*([F.col("inside").alias("__inside")] if group else []), F.col("place").alias("__place"), F.col("sum").alias("running"))
    same = F.col("rank") == F.col("__place")
    if group:
        same = same & F.col("inside").eqNullSafe(F.col("__inside"))
        totals = ranked.groupBy(F.col("inside").alias("__all")).agg(F.sum("value").alias("total"))
        found = ranked.join(sums, same).join(totals, F.col("inside").eqNullSafe(F.col("__all")))
    else:
        found = ranked.join(sums, same).withColumn("total", ranked.agg(F.sum("value")).scalar())
    mark = f"{of.column}/{key}"
    found = found.select(
        F.col("member").alias("__member"),
        *([F.col("inside").alias("__group")] if group else []),
        *[F.col(c).alias(f"{mark}/{c}") for c in ("rank", "running", "total")],
    )
    condition = F.col(f"`{at[0]}`") == F.col("__member")
    if group:
        condition = condition & inside.eqNullSafe(F.col("__group"))
    return joined.join(found, condition, "left").drop("__member", "__group")


def _align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of two small results on their group keys; NULL keys meet."""
    if not keys:
        # Both sides are one row: their values are read as scalars.
        return left.withColumns(
            {c: right.select(F.col(f"`{c}`")).scalar() for c in right.columns}
        )
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys]
    )
    rest_left = [c for c in left.columns if c not in keys]
    rest_right = [c for c in right.columns if c not in keys]
    joined = left.withColumn("__l", F.lit(1)).join(renamed, condition, "full")
    return joined.select(
        *[
            F.when(F.col("__l") == 1, F.col(f"`{k}`")).otherwise(F.col(f"`__{k}`")).alias(k)
            for k in keys
        ],
        *[F.col(f"`{c}`") for c in rest_left + rest_right],
    )


def _value(node: Node | Leaf) -> Column:
    match node:
        case Leaf():
            return F.col(f"`{node.column}`")
        case Ratio(top, bottom):
            return ratio(_value(top), _value(bottom))
        case Change(now, before):
            return _change(_value(now), _value(before))
        case Place(of, key, what, limit):
            mark = f"{of.column}/{key}"
            part = ratio(F.col(f"`{mark}/running`"), F.col(f"`{mark}/total`"))
            if what == "flag":
                return F.when(F.col(f"`{mark}/rank`").isNotNull(), F.when(part <= limit, 1).otherwise(0))
            return part if what == "share" else F.col(f"`{mark}/{what}`")


def _finish(
    joined: DataFrame, keys: Sequence[str], group_by: Sequence[GroupKey], trees: Mapping[str, Node]
) -> DataFrame:
    result = joined.select(
        *[F.col(f"`{k}`").alias(column) for k, (_, column) in zip(keys, group_by)],
        *[_value(node).alias(name) for name, node in trees.items()],
    )
    blank = reduce(lambda a, b: a & b, [F.col(f"`{m}`").isNull() for m in trees])
    return result.filter(~blank)


# ------------------------------------------------------- time intelligence

MONTH = ("DimDate", "YearMonth")
SHIFTS = {"Previous Month": 1, "Previous Year": 12}


def monthly_series(
    star: Mapping[str, DataFrame],
    measure: str,
    group_by: Sequence[GroupKey] = (),
    filters: Sequence[Filter] = (),
) -> DataFrame:
    """A measure by calendar month with its prior, year-to-date and rolling values.

    Months without data see the past they have, and no month looks at a row
    position.  Values over several months are those of the months taken
    together: sums are added, distinct counts count each item once, and a ratio
    divides the two values of the whole period.
    """
    names = [column for _, column in group_by]
    node = tree(measure)
    if not isinstance(node, Base | Ratio) or not all(isinstance(x, Leaf) and not x.changes for x in leaves(lowered(node))):
        raise ValueError(f"{measure} has a period of its own")
    parts = [node.name] if isinstance(node, Base) else [node.top.name, node.bottom.name]
    shaped = [_periods(star, part, names, group_by, filters) for part in parts]
    if isinstance(node, Base):
        series = shaped[0]
    else:
        shaped = [s.select(*names, "target", *[F.col(c).alias(f"{c}{i}") for c in PERIODS]) for i, s in enumerate(shaped)]
        both = _align(*shaped, [*names, "target"])
        series = both.select(*names, "target", *[ratio(f"{c}0", f"{c}1").alias(c) for c in PERIODS])
        series = series.where(F.coalesce(*PERIODS).isNotNull())
    return _with_changes(series, names)


PERIODS = ("Value", "PreviousMonth", "PreviousYear", "YearToDate", "Rolling3M", "Rolling12M")


def _periods(
    star: Mapping[str, DataFrame], part: str, names: Sequence[str], group_by: Sequence[GroupKey], filters: Sequence[Filter]
) -> DataFrame:
    """names, target month and PERIODS of one base measure."""
    last = star["DimDate"].agg(F.max(month_index(DAY))).scalar()
    if BASE[part].additive:
        return _sums_over_months(star, part, names, group_by, filters, last)
    if BASE[part].item is None:
        raise ValueError(f"{part} has no value over several months")
    return _distinct_over_months(star, part, names, group_by, filters, last)


def _month_of(column: str) -> Column:
    return F.substring(column, 1, 4).cast("int") * 12 + F.substring(column, 6, 2).cast("int")


def _distinct_over_months(star, part, names, group_by, filters, last) -> DataFrame:
    """Distinct counts over sliding periods in one pass over (group, item, month).

    An item active in month m counts in every period that ends between m and the
    period's reach, or up to the month before its next activity, which takes over
    from there.  So each activity is one interval of target months per period;
    intervals are summed as +1 at their beginning and -1 behind their end.  No
    activity is ever repeated per target month.
    """
    fact = BASE[part].fact
    rows = _fact_rows(star, fact, [part], [*group_by, MONTH], filters)
    groups = [F.col(f"`{table}.{column}`").alias(column) for table, column in group_by]
    active = rows.select(
        *groups, _month_of("`DimDate.YearMonth`").alias("m"), BASE[part].item().alias("item")
    ).where("item IS NOT NULL AND m IS NOT NULL").distinct()
    following = F.lead("m").over(Window.partitionBy(*names, "item").orderBy("m"))
    active = active.withColumn("until", F.coalesce(following - 1, F.lit(2**31 - 2)))
    m, until = F.col("m"), F.col("until")
    reach = {"ytd": F.ceil(m / 12).cast("int") * 12, "r3": m + 2, "r12": m + 11}
    event = lambda at, v, a, b, c: F.struct(
        at.alias("target"), F.lit(v).alias("v"), F.lit(a).alias("ytd"), F.lit(b).alias("r3"), F.lit(c).alias("r12")
    )
    events = F.array(
        event(m, 1, 1, 1, 1),
        event(F.least(until, reach["ytd"]) + 1, 0, -1, 0, 0),
        event(F.least(until, reach["r3"]) + 1, 0, 0, -1, 0),
        event(F.least(until, reach["r12"]) + 1, 0, 0, 0, -1),
    )
    changes = (
        active.select(*names, F.inline(events)).groupBy(*names, "target")
        .agg(*[F.sum(c).alias(c) for c in ("v", "ytd", "r3", "r12")])
    )
    # one row per group and month: as many as the calendar has, from the group's first activity on
    first = changes.groupBy(*names).agg(F.min("target").alias("first")) if names else changes.agg(F.min("target").alias("first"))
    months = first.withColumn("last", last).where("first <= last").select(
        *names, F.explode(F.sequence(F.col("first"), F.col("last"))).alias("target")
    )
    dense = _align(months.withColumn("here", F.lit(1)), changes, [*names, "target"]).where("here = 1")
    order = Window.partitionBy(*(names or [F.lit(0)])).orderBy("target")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    value = F.nullif(F.col("v"), F.lit(0))
    blank = lambda c: F.nullif(c, F.lit(0))
    out = dense.select(
        *names,
        "target",
        value.alias("Value"),
        F.lag(value, 1).over(order).alias("PreviousMonth"),
        F.lag(value, 12).over(order).alias("PreviousYear"),
        blank(F.sum("ytd").over(running)).alias("YearToDate"),
        blank(F.sum("r3").over(running)).alias("Rolling3M"),
        blank(F.sum("r12").over(running)).alias("Rolling12M"),
    )
    return out.where(F.coalesce(*PERIODS).isNotNull())


def _sums_over_months(star, part, names, group_by, filters, last) -> DataFrame:
    """Every month's value is sent to the twelve months after it, where one aggregate picks and adds."""
    measure = part
    by_month = evaluate(star, [measure], [*group_by, MONTH], filters)
    index = _month_of("YearMonth")
    spread = (
        by_month.select(*names, index.alias("m"), F.col(f"`{measure}`").alias("v"))
        .withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(12))))
        .withColumn("target", F.col("m") + F.col("offset"))
        .filter(F.col("target") <= last)
    )
    offset = F.col("offset")
    same_year = F.floor((F.col("target") - 1) / 12) == F.floor((F.col("m") - 1) / 12)

    def at(months: int) -> Column:
        return F.max(F.when(offset == months, F.col("v")))

    def over(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("v")))

    return spread.groupBy(*names, "target").agg(
        at(0).alias("Value"),
        at(1).alias("PreviousMonth"),
        at(12).alias("PreviousYear"),
        over(same_year).alias("YearToDate"),
        over(offset <= 2).alias("Rolling3M"),
        over(offset <= 11).alias("Rolling12M"),
    )


def _with_changes(shaped: DataFrame, names: Sequence[str]) -> DataFrame:
    year = F.floor((F.col("target") - 1) / 12).cast("int")
    month = F.col("target") - year * 12
    return shaped.select(
        *names,
        F.make_date(year, month, F.lit(1)).alias("MonthStart"),
        "Value",
        "PreviousMonth",
        _change("Value", "PreviousMonth").alias("MoMChange"),
        ratio(_change("Value", "PreviousMonth"), "PreviousMonth").alias("MoMPct"),
        "PreviousYear",
        _change("Value", "PreviousYear").alias("YoYChange"),
        ratio(_change("Value", "PreviousYear"), "PreviousYear").alias("YoYPct"),
        "YearToDate",
        "Rolling3M",
        "Rolling12M",
    )


def _change(current: Column | str, previous: Column | str) -> Column:
    """Difference with blanks as zero, blank only when both are."""
    current, previous = (F.col(c) if isinstance(c, str) else c for c in (current, previous))
    both_blank = current.isNull() & previous.isNull()
    return F.when(
        ~both_blank, F.coalesce(current, F.lit(0)) - F.coalesce(previous, F.lit(0))
    )


def daily_to_date(
    star: Mapping[str, DataFrame], measure: str, filters: Sequence[Filter] = ()
) -> DataFrame:
    """Month-to-date and year-to-date of an additive measure for every calendar day."""
    daily = evaluate(star, [measure], [("DimDate", "FullDate")], filters)
    days = star["DimDate"].select("FullDate", "CalendarYear", "MonthNumber")
    spine = days.join(daily, "FullDate", "left").withColumnRenamed(measure, "Value")
    year = Window.partitionBy("CalendarYear").orderBy("FullDate")
    month = Window.partitionBy("CalendarYear", "MonthNumber").orderBy("FullDate")
    return (
        spine.withColumns(
            {"MonthToDate": F.sum("Value").over(month), "YearToDate": F.sum("Value").over(year)}
        )
        .filter(F.col("YearToDate").isNotNull())
        .select("FullDate", "Value", "MonthToDate", "YearToDate")
    )


# ------------------------------------------------- context-bound measures


def new_customers(
    star: Mapping[str, DataFrame], group_by: Sequence[GroupKey] = (MONTH,)
) -> DataFrame:
    """Customers whose first order falls into each period, by DimDate and DimCustomer columns."""
    days = [c for table, c in group_by if table == "DimDate"]
    own = [c for table, c in group_by if table == "DimCustomer"]
    calendar = star["DimDate"].select(F.col("FullDate").alias("FirstOrderDate"), *days)
    return (
        star["DimCustomer"]
        .select("CustomerId", "FirstOrderDate", *own)
        .join(calendar, "FirstOrderDate")
        .groupBy(*[c for _, c in group_by])
        .agg(F.count(F.lit(1)).alias("New Customers"))
    )


def retention_percent(
    star: Mapping[str, DataFrame], group_by: Sequence[str], condition: Column | None = None
) -> DataFrame:
    """Retention of a cell; NULL unless it is exactly one cohort and one month."""
    rows = star["FactCohortRetention"]
    rows = rows.filter(condition) if condition is not None else rows
    return rows.groupBy(*group_by).agg(_one_cell().alias("Retention %"))


def rfm_share(
    star: Mapping[str, DataFrame],
    group_by: Sequence[GroupKey] = ((RFM, "RfmSegment"),),
    filters: Sequence[Filter] = (),
) -> DataFrame:
    """RFM customers and value, and the share of all segments under the other filters."""
    result = evaluate(star, ["RFM Customers", "RFM Monetary Value"], group_by, filters)
    others = [c for _, c in group_by if c != "RfmSegment"]
    # A customer has one segment per snapshot, so segment counts add up.
    total = F.sum("RFM Customers").over(Window.partitionBy(*(others or [F.lit(0)])))
    return result.withColumn("RFM Customer Share %", ratio("RFM Customers", total))


def product_revenue_rank(
    star: Mapping[str, DataFrame], filters: Sequence[Filter] = ()
) -> DataFrame:
    """Dense rank of products by revenue among the selected ones."""
    base = evaluate(star, ["Product Revenue"], [("FactOrderLines", "ProductId")], filters)
    ranked = order_globally(
        base.withColumnRenamed("Product Revenue", "ProductRevenue"),
        "ProductId",
        [Ordering("ProductRevenue", descending=True, dense_rank="ProductRevenueRank")],
    )
    return ranked


def customer_pareto(
    star: Mapping[str, DataFrame], filters: Sequence[Filter] = (), share: float = 0.80
) -> DataFrame:
    """Customer revenue rank, cumulative revenue, share and flag.

    The rank is dense and is used as the number of customers to add up, so
    after ties the cumulative value covers fewer customers than the position.
    """
    value = "RevenueAfterRefund"
    base = evaluate(star, ["Revenue After Refund"], [("FactOrders", "CustomerId")], filters)
    base = base.select(
        "CustomerId", F.col("`Revenue After Refund`").cast("decimal(18,2)").alias(value)
    )
    ranked = order_globally(
        base,
        "CustomerId",
        [
            Ordering(
                value,
                descending=True,
                row_number="Place",
                dense_rank="CustomerRevenueRank",
                running_sums={"Running": value},
            )
        ],
    )
    # Over the ranked rows: reads the written input again, not the facts.
    total = ranked.agg(F.sum(value)).scalar()
    prefix = ranked.select(
        F.col("Place").alias("CustomerRevenueRank"),
        F.col("Running").alias("CumulativeCustomerRevenue"),
    )
    part = ratio("CumulativeCustomerRevenue", "__total")
    return (
        ranked.drop("Place", "Running")
        .join(prefix, "CustomerRevenueRank")
        .withColumn("__total", total)
        .select(
            "CustomerId",
            value,
            "CustomerRevenueRank",
            "CumulativeCustomerRevenue",
            part.alias("ParetoRevenuePct"),
            F.when(part <= share, 1).otherwise(0).alias("ParetoFlag"),
        )
    )
