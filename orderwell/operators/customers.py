"""Customer value, cadence, lifecycle, cohorts and RFM."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import (
    money,
    month_diff,
    month_start,
    ratio,
    round_cents,
    sum_money,
    zero_if_null,
)
from orderwell.functions.ordered import Ordering, order_globally
from orderwell.functions.scalars import count_if
from orderwell.operators.facts import (
    Tables,
    as_of_date,
    customer_segments,
    first_valid_orders,
    is_valid,
    line_facts,
    order_headers,
    order_summary,
    product_names,
    valid_orders,
)
from orderwell.operators.validation import LAST_DATE, as_date, between, must_exist

# Lifecycle limits in days and the default cadence.
DEFAULT_GAP = 45
MIN_TENURE_DAYS = 90
AT_RISK_STATUSES = ("At Risk", "High Risk")
WIN_BACK_STATUSES = ("High Risk", "At Risk", "One-Time Lapsed")

# RFM segments by score range (R, F, M), first match wins.
RFM_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (4, 5), (1, 5)),
    ("New Customers", (5, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (4, 5), (2, 3), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Hibernating", (1, 2), (1, 2), (1, 5)),
)
RFM_OTHER = "Needs Attention"


def lifecycle_status(orders: Column, recency: Column, gap: Column) -> Column:
    """Lifecycle from order count, days since the last order and personal cadence."""
    pace = F.coalesce(gap, F.lit(float(DEFAULT_GAP)))
    repeat = orders >= 2
    return (
        F.when(orders == 0, "Prospect")
        .when((orders == 1) & (recency > 90), "One-Time Lapsed")
        .when(repeat & (recency > F.greatest(pace * 2, F.lit(90.0))), "High Risk")
        .when(repeat & (recency > F.greatest(pace * 1.5, F.lit(60.0))), "At Risk")
        .otherwise("Active")
    )


def annual_run_rate(revenue: Column, tenure_days: Column) -> Column:
    """Lifetime revenue scaled to a year of tenure, in cents."""
    days = F.greatest(tenure_days, F.lit(MIN_TENURE_DAYS)).cast("double")
    return round_cents(revenue.cast("double") / (days / F.lit(365.25)))


def customer_totals(t: Tables) -> DataFrame:
    """Lifetime totals of customers with valid orders.

    The average gap is (last - first) / (orders - 1): the gaps telescope, so no
    window over a customer's orders is needed and a hot customer costs nothing.
    """
    return (
        valid_orders(t)
        .groupBy("CustomerId")
        .agg(
            F.min("OrderDate").alias("FirstOrderDate"),
            F.max("OrderDate").alias("LastOrderDate"),
            F.count(F.lit(1)).alias("LifetimeOrders"),
            sum_money("NetRevenue").alias("LifetimeRevenue"),
            sum_money("RevenueAfterRefund").alias("LifetimeRevenueAfterRefund"),
            sum_money("GrossProfit").alias("LifetimeGrossProfit"),
            F.sum("ReturnedUnits").alias("ReturnedUnits"),
        )
        .withColumn(
            "AvgDaysBetweenOrders",
            ratio(F.date_diff("LastOrderDate", "FirstOrderDate"), F.col("LifetimeOrders") - 1),
        )
    )


def customer_metrics(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Grain: one customer, prospects included."""
    as_of = as_of_date(t) if as_of is None else as_of
    joined = customer_segments(t).join(customer_totals(t), "CustomerId", "left")
    filled = joined.withColumns(
        {
            "AsOfDate": as_of,
            "LifetimeOrders": zero_if_null("LifetimeOrders"),
            "AverageOrderValue": F.coalesce(
                ratio("LifetimeRevenue", "LifetimeOrders"), F.lit(0.0)
            ),
            "LifetimeRevenue": money(zero_if_null("LifetimeRevenue"), 18),
            "LifetimeRevenueAfterRefund": money(zero_if_null("LifetimeRevenueAfterRefund"), 18),
            "LifetimeGrossProfit": money(zero_if_null("LifetimeGrossProfit"), 18),
            "ReturnedUnits": zero_if_null("ReturnedUnits"),
        }
    )
    recency = F.date_diff("AsOfDate", "LastOrderDate")
    return filled.select(
        "CustomerId",
        F.concat_ws(" ", "FirstName", "LastName").alias("CustomerName"),
        "Email",
        "AcquisitionDate",
        "AcquisitionSource",
        "SegmentName",
        "IsActive",
        "AsOfDate",
        "FirstOrderDate",
        "LastOrderDate",
        "LifetimeOrders",
        "LifetimeRevenue",
        "LifetimeRevenueAfterRefund",
        "LifetimeGrossProfit",
        "AverageOrderValue",
        "AvgDaysBetweenOrders",
        recency.alias("RecencyDays"),
        "ReturnedUnits",
        (F.col("LifetimeOrders") >= 2).cast("int").alias("IsRepeatCustomer"),
        annual_run_rate(
            F.col("LifetimeRevenueAfterRefund"), F.date_diff("AsOfDate", "AcquisitionDate")
        ).alias("Projected12MonthRevenue"),
        lifecycle_status(F.col("LifetimeOrders"), recency, F.col("AvgDaysBetweenOrders")).alias(
            "LifecycleStatus"
        ),
    )


# ------------------------------------------------------------------ cohorts


def cohort_retention(t: Tables) -> DataFrame:
    """Grain: cohort month and months elapsed.

    Orders shrink to one row per customer and month first; a customer then has
    at most as many rows as the data has months.
    """
    active = (
        valid_orders(t).select("CustomerId", F.col("MonthStart").alias("ActivityMonth")).distinct()
    )
    cohort = F.min("ActivityMonth").over(Window.partitionBy("CustomerId"))
    counts = (
        active.withColumn("CohortMonth", cohort)
        .groupBy("CohortMonth", "ActivityMonth")
        .agg(F.count(F.lit(1)).alias("ActiveCustomers"))
    )
    elapsed = month_diff("ActivityMonth", "CohortMonth")
    size = F.max(F.when(elapsed == 0, F.col("ActiveCustomers"))).over(
        Window.partitionBy("CohortMonth")
    )
    return counts.select(
        "CohortMonth",
        elapsed.alias("MonthsSinceFirstOrder"),
        "ActiveCustomers",
        size.alias("CohortSize"),
        ratio("ActiveCustomers", size).alias("RetentionRate"),
    )


def _previous_retention() -> Column:
    order = Window.partitionBy("CohortMonth").orderBy("MonthsSinceFirstOrder")
    return F.lag("RetentionRate").over(order)


def cohort_retention_range(
    t: Tables, start: dt.date | str, end: dt.date | str, max_months: int = 12
) -> DataFrame:
    """Retention of the cohorts between two dates, with the change to the month before."""
    first, last = as_date(start, "start"), as_date(end, "end")
    if first > last:
        raise ValueError("start must not be after end")
    between(max_months, 0, 36, "max_months")
    chosen = cohort_retention(t).filter(
        F.col("CohortMonth").between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)))
        & (F.col("MonthsSinceFirstOrder") <= max_months)
    )
    return (
        chosen.withColumn("PreviousMonthRetention", _previous_retention())
        .withColumn(
            "RetentionPointChange", F.col("RetentionRate") - F.col("PreviousMonthRetention")
        )
        .orderBy("CohortMonth", "MonthsSinceFirstOrder")
    )


def retention_curve(t: Tables, max_months: int = 12) -> DataFrame:
    return (
        cohort_retention(t)
        .filter(F.col("MonthsSinceFirstOrder") <= max_months)
        .withColumn("PreviousMonthRetention", _previous_retention())
        .orderBy("CohortMonth", "MonthsSinceFirstOrder")
    )


def cohort_matrix(t: Tables, months: int = 12, cohorts: int | None = None) -> DataFrame:
    """Cohorts as rows and elapsed months as columns M0, M1, ...

    ``cohorts`` keeps the latest so many; listing the columns saves the extra
    job a pivot without values would run.
    """
    retention = cohort_retention(t).filter(F.col("MonthsSinceFirstOrder") <= months)
    if cohorts is not None:
        latest = (
            retention.select("CohortMonth")
            .distinct()
            .orderBy(F.col("CohortMonth").desc())
            .limit(cohorts)
        )
        retention = retention.join(latest, "CohortMonth", "left_semi")
    wide = (
        retention.groupBy("CohortMonth")
        .pivot("MonthsSinceFirstOrder", list(range(months + 1)))
        .agg(F.max("RetentionRate"))
    )
    return wide.withColumnsRenamed({str(m): f"M{m}" for m in range(months + 1)})


# ---------------------------------------------------------------------- RFM


def _rfm_segment() -> Column:
    def within(column: str, bounds: tuple[int, int]) -> Column:
        return F.col(column).between(*bounds)

    segment = None
    for name, r, f, m in RFM_SEGMENTS:
        match = within("RScore", r) & within("FScore", f) & within("MScore", m)
        segment = F.when(match, name) if segment is None else segment.when(match, name)
    return segment.otherwise(RFM_OTHER)


def rfm_base(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Recency, frequency and value of orders up to and including the snapshot day."""
    snapshot = F.lit(as_of).cast("date") if as_of else as_of_date(t)
    orders = valid_orders(t)
    if as_of:
        after = F.lit(as_of + dt.timedelta(days=1)).cast("timestamp_ntz")
        orders = orders.filter(F.col("OrderDateTime") < after)
    return (
        orders.groupBy("CustomerId")
        .agg(
            F.max("OrderDate").alias("__last"),
            F.count(F.lit(1)).alias("Frequency"),
            sum_money("RevenueAfterRefund").alias("MonetaryValue"),
        )
        .select(
            snapshot.alias("SnapshotDate"),
            "CustomerId",
            F.date_diff(snapshot, F.col("__last")).alias("RecencyDays"),
            "Frequency",
            "MonetaryValue",
        )
    )


def score_rfm(base: DataFrame, method: str = "ntile") -> DataFrame:
    """Quintile scores, code and segment.

    ``ntile`` gives leftover rows to the first buckets; ``percentile`` is
    ceil(rank * 5 / n).  They differ when n is not a multiple of 5.
    """
    if method not in ("ntile", "percentile"):
        raise ValueError("method must be 'ntile' or 'percentile'")
    measures = {"R": "RecencyDays", "F": "Frequency", "M": "MonetaryValue"}
    if method == "ntile":
        orderings = [Ordering(v, ntiles={f"__{k}": 5}) for k, v in measures.items()]
    else:
        orderings = [
            Ordering(v, row_number=f"__n{k}", total="__customers" if k == "R" else None)
            for k, v in measures.items()
        ]
    scored = order_globally(base, "CustomerId", orderings)
    if method == "percentile":
        fifths = {
            f"__{k}": F.ceil(F.col(f"__n{k}") * 5 / F.col("__customers")).cast("int") for k in measures
        }
        scored = scored.withColumns(fifths)
    scored = scored.withColumns(
        {"RScore": F.lit(6) - F.col("__R"), "FScore": F.col("__F"), "MScore": F.col("__M")}
    )
    code = F.concat(*[F.col(c).cast("string") for c in ("RScore", "FScore", "MScore")])
    return scored.select(
        *base.columns,
        "RScore",
        "FScore",
        "MScore",
        code.alias("RfmCode"),
        _rfm_segment().alias("Segment"),
    )


def rfm_snapshot(
    t: Tables, as_of: dt.date | str | None = None, method: str = "ntile"
) -> DataFrame:
    day = as_date(as_of, "as_of") if as_of is not None else None
    if day == LAST_DATE:
        raise ValueError("as_of must be earlier than 9999-12-31")
    return score_rfm(rfm_base(t, day), method)


def rfm_summary(snapshot: DataFrame) -> DataFrame:
    """Segment sizes and values of a snapshot."""
    return (
        snapshot.groupBy("Segment")
        .agg(
            F.count(F.lit(1)).alias("Customers"),
            ratio(F.sum("RecencyDays"), F.count("RecencyDays")).alias("AvgRecencyDays"),
            ratio(F.sum("Frequency"), F.count("Frequency")).alias("AvgFrequency"),
            F.sum("MonetaryValue").alias("SegmentValue"),
        )
        .orderBy(F.col("SegmentValue").desc(), "Segment")
    )


def refresh_rfm(t: Tables, path: str, as_of: dt.date | str | None = None) -> DataFrame:
    """Replace one snapshot day in the stored table and return its summary."""
    from orderwell.sources.snapshots import read_snapshot, write_snapshot

    if as_of is None:
        last = t["orders"].agg(F.max("OrderDate").cast("date").alias("d")).first()["d"]
        if last is None:
            raise ValueError("RFM needs orders or an explicit as_of date")
        as_of = last + dt.timedelta(days=1)
    day = as_date(as_of, "as_of")
    write_snapshot(rfm_snapshot(t, day), path)
    return rfm_summary(read_snapshot(t["orders"].sparkSession, path, day))


# ----------------------------------------------------------- customer views


def customer_360(t: Tables, customer_id: int) -> dict[str, DataFrame]:
    """Profile, order history and five preferred products of one customer.

    The customer filter is put on the source tables, so it reaches the scans.
    """
    must_exist(t["customers"], "CustomerId", customer_id, "CustomerId")
    own_orders = t["orders"].filter(F.col("CustomerId") == customer_id)
    ids = own_orders.select("OrderId")
    own = {
        name: t[name].join(ids, "OrderId", "left_semi")
        for name in ("order_items", "returns", "shipments")
    }
    own["customers"] = t["customers"].filter(F.col("CustomerId") == customer_id)
    own["orders"] = own_orders
    mine = ChainMap(own, t)
    profile_columns = [
        "CustomerId", "CustomerName", "AcquisitionDate", "AcquisitionSource", "SegmentName",
        "FirstOrderDate", "LastOrderDate", "LifetimeOrders", "LifetimeRevenue",
        "LifetimeRevenueAfterRefund", "LifetimeGrossProfit", "AverageOrderValue",
        "AvgDaysBetweenOrders", "RecencyDays", "Projected12MonthRevenue", "LifecycleStatus",
    ]
    history_columns = [
        "OrderId", "OrderDateTime", "CustomerOrderNumber", "IsRepeatPurchase", "ChannelName",
        "StatusName", "NetRevenue", "RevenueAfterRefund", "GrossProfit", "RefundAmount",
        "DeliveryDays", "IsOnTime",
    ]
    # The as-of date still looks at the orders of all customers.
    profile = customer_metrics(mine, as_of_date(t))
    history = (
        order_summary(mine)
        .select(*history_columns)
        .orderBy(F.col("OrderDateTime").desc(), F.col("OrderId").desc())
    )
    top = (
        line_facts(mine, only_valid=True)
        .groupBy("ProductId")
        .agg(F.sum("Quantity").alias("Units"), F.sum("NetRevenue").alias("NetRevenue"))
        .orderBy(F.col("NetRevenue").desc(), "ProductId")
        .limit(5)
    )
    # Five rows at most from here on.
    rank = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("NetRevenue").desc(), "ProductId")
    )
    products = (
        top.withColumn("PreferenceRank", rank)
        .join(product_names(t).select("ProductId", "ProductName", "CategoryName"), "ProductId")
        .select(
            "ProductId", "ProductName", "CategoryName", "Units", "NetRevenue", "PreferenceRank"
        )
        .orderBy("PreferenceRank")
    )
    return {
        "profile": profile.select(*profile_columns),
        "orders": history,
        "products": products,
    }


def repeat_purchases(t: Tables) -> DataFrame:
    """Grain: customer whose first valid order has lines; days to the next such order.

    Both dates come from one aggregate per customer, with no window over orders.
    """
    valid = order_headers(t).filter(is_valid()).select("OrderId", "CustomerId", "OrderDate")
    sold = valid.join(t["order_items"].select("OrderId"), "OrderId", "left_semi")
    firsts = first_valid_orders(t).select("OrderId", F.lit(True).alias("__first"))
    return (
        sold.join(firsts, "OrderId", "left")
        .groupBy("CustomerId")
        .agg(
            F.max(F.when(F.col("__first"), F.col("OrderDate"))).alias("FirstOrderDate"),
            F.min(F.when(F.col("__first").isNull(), F.col("OrderDate"))).alias("NextOrderDate"),
        )
        .filter(F.col("FirstOrderDate").isNotNull())
        .withColumn("DaysToSecondOrder", F.date_diff("NextOrderDate", "FirstOrderDate"))
    )


def repeat_timing(t: Tables) -> DataFrame:
    """How many first-time customers ordered again within 30, 60 and 90 days."""
    days = F.col("DaysToSecondOrder")
    return repeat_purchases(t).agg(
        F.count(F.lit(1)).alias("FirstTimeCustomers"),
        count_if(days <= 30).alias("RepeatedWithin30Days"),
        count_if(days <= 60).alias("RepeatedWithin60Days"),
        count_if(days <= 90).alias("RepeatedWithin90Days"),
        ratio(F.sum(days), F.count(days)).alias("AvgDaysToSecondOrder"),
        ratio(count_if(days <= 90), F.count(F.lit(1))).alias("RepeatWithin90DayRate"),
    )


def repeat_flags(t: Tables) -> DataFrame:
    """Per customer: second order within 30, 60, 90 days (false when there is none)."""
    days = F.col("DaysToSecondOrder")
    flags = {
        f"RepeatedWithin{n}Days": F.coalesce(days <= n, F.lit(False)).cast("int")
        for n in (30, 60, 90)
    }
    return repeat_purchases(t).withColumns(flags)


def churn_risk(t: Tables) -> DataFrame:
    """Lapsing customers, ranked by value inside their status."""
    columns = [
        "CustomerId", "SegmentName", "LifetimeOrders", "LifetimeRevenueAfterRefund",
        "AverageOrderValue", "AvgDaysBetweenOrders", "RecencyDays", "LifecycleStatus",
    ]
    lapsing = customer_metrics(t).filter(F.col("LifecycleStatus").isin(*WIN_BACK_STATUSES))
    ranked = order_globally(
        lapsing.select(*columns),
        "CustomerId",
        [Ordering("LifetimeRevenueAfterRefund", descending=True, rank="ValueRankWithinRisk")],
        group="LifecycleStatus",
    )
    place = F.array_position(
        F.array(*[F.lit(s) for s in WIN_BACK_STATUSES]), F.col("LifecycleStatus")
    )
    return ranked.orderBy(place, "ValueRankWithinRisk", "CustomerId")


def value_tiers(t: Tables) -> DataFrame:
    """Deciles of projected value and rank by historical value, purchasers only."""
    columns = [
        "CustomerId", "SegmentName", "LifetimeOrders", "LifetimeRevenueAfterRefund",
        "LifetimeGrossProfit", "Projected12MonthRevenue",
    ]
    buyers = customer_metrics(t).filter(F.col("LifetimeOrders") > 0).select(*columns)
    return order_globally(
        buyers,
        "CustomerId",
        [
            Ordering("Projected12MonthRevenue", ntiles={"ProjectedValueDecile": 10}),
            Ordering(
                "LifetimeRevenueAfterRefund", descending=True, dense_rank="HistoricalValueRank"
            ),
        ],
    ).orderBy(
        F.col("ProjectedValueDecile").desc(),
        F.col("Projected12MonthRevenue").desc(),
        "CustomerId",
    )


def churn_summary(t: Tables) -> DataFrame:
    return (
        customer_metrics(t)
        .groupBy("LifecycleStatus")
        .agg(
            F.count(F.lit(1)).alias("Customers"),
            F.sum("LifetimeRevenueAfterRefund").alias("RevenueAtRisk"),
            F.sum("Projected12MonthRevenue").alias("Projected12MonthRevenue"),
            ratio(F.sum("RecencyDays"), F.count("RecencyDays")).alias("AverageRecencyDays"),
        )
    )


def lifecycle_counts(t: Tables) -> DataFrame:
    return customer_metrics(t).groupBy("LifecycleStatus").agg(
        F.count(F.lit(1)).alias("Customers")
    )


def order_gaps(t: Tables) -> DataFrame:
    """Valid orders with the gap to the customer's previous one, by month start."""
    from orderwell.operators.facts import order_neighbours

    return order_neighbours(t).withColumn("MonthStart", month_start("OrderDate"))
