"""Report pages as measure queries: what each visual of the six pages shows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.plans.measures import Filter, evaluate, monthly_series

Star = Mapping[str, DataFrame]

MONTH = ("DimDate", "YearMonth")
CHANNEL = ("DimChannel", "ChannelName")
REGION = ("DimGeography", "Region")
CATEGORY = ("DimProduct", "CategoryName")


def latest_months(star: Star, months: int = 6) -> Filter:
    """The last months that have orders, as a date filter: the page's default choice."""
    last = star["FactOrders"].agg(F.max("OrderDate").alias("d")).scalar()
    first = F.add_months(F.trunc(last, "MM"), 1 - months)
    return ("DimDate", (F.col("FullDate") >= first) & (F.col("FullDate") <= last))


def executive_cards(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star,
        [
            "Revenue After Refund", "Gross Profit After Refund", "Gross Margin After Refund %",
            "Orders", "Active Customers", "Average Order Value",
        ],
        filters=filters,
    )


def executive_by_channel(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star, ["Revenue After Refund", "Gross Profit After Refund"], [CHANNEL], filters
    ).orderBy(F.col("`Revenue After Refund`").desc(), "ChannelName")


def category_contribution(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star,
        ["Product Revenue", "Product Gross Profit", "Product Gross Margin %", "Return Rate"],
        [CATEGORY],
        filters,
    )


def exception_strip(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star, ["Refund Rate", "Return Rate", "Late Delivery %", "Churn Indicator %"], (), filters
    )


def revenue_trend(star: Star) -> DataFrame:
    """Revenue after refund by month with its trailing twelve months."""
    return monthly_series(star, "Revenue After Refund").select(
        "MonthStart", "Value", "Rolling12M"
    )


def region_channel_matrix(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star,
        ["Revenue After Refund", "Gross Margin After Refund %", "Orders"],
        [REGION, CHANNEL],
        filters,
    )


def channel_rank_by_month(star: Star) -> DataFrame:
    """Channels ranked by revenue inside each month."""
    revenue = evaluate(star, ["Revenue"], [MONTH, CHANNEL])
    inside = Window.partitionBy("YearMonth").orderBy(F.col("Revenue").desc())
    return revenue.withColumn("ChannelRank", F.rank().over(inside))


def leakage_bridge(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    """Steps from gross revenue to after-refund profit."""
    measures = ["Gross Revenue", "Discount Amount", "Refund Amount", "Gross Profit After Refund"]
    row = evaluate(star, measures, (), filters)
    steps = F.array(
        *[
            F.struct(
                F.lit(i).alias("Step"),
                F.lit(m).alias("Label"),
                F.col(f"`{m}`").cast("decimal(28,2)").alias("Amount"),
            )
            for i, m in enumerate(measures, 1)
        ]
    )
    return row.select(F.inline(steps))


def daily_tail(star: Star, days: int = 30) -> DataFrame:
    """The last days that sold anything."""
    return (
        evaluate(star, ["Revenue After Refund"], [("DimDate", "FullDate")])
        .orderBy(F.col("FullDate").desc())
        .limit(days)
        .orderBy("FullDate")
    )


def sales_detail(star: Star) -> DataFrame:
    """Month, channel and region with growth.

    Growth comes from the revenue series of the same groups.
    """
    keys = [CHANNEL, REGION]
    base = evaluate(star, ["Orders", "Average Order Value"], [*keys, MONTH]).withColumn(
        "MonthStart", F.to_date(F.concat("YearMonth", F.lit("-01")))
    )
    growth = monthly_series(star, "Revenue", keys).select(
        "ChannelName", "Region", "MonthStart", F.col("Value").alias("Revenue"), "MoMPct", "YoYPct"
    )
    return growth.join(base.drop("YearMonth"), ["ChannelName", "Region", "MonthStart"])


def customer_cards(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star,
        [
            "Active Customers", "Repeat Customers", "Average Historical CLV",
            "Projected 12M Customer Value", "Revenue at Risk",
        ],
        filters=filters,
    )


def risk_table(star: Star) -> DataFrame:
    return (
        star["DimCustomer"]
        .filter(F.col("LifecycleStatus").isin("At Risk", "High Risk"))
        .select(
            "CustomerId", "SegmentName", "LifecycleStatus", "RecencyDays", "LifetimeOrders",
            "LifetimeRevenueAfterRefund", "Projected12MonthRevenue",
        )
    )


def top_products(star: Star, n: int = 15) -> DataFrame:
    """Best sellers with margin, units, returns and rating."""
    measures = [
        "Product Revenue", "Product Gross Profit", "Product Gross Margin %", "Units Sold",
        "Return Rate", "Average Rating",
    ]
    keys = [("DimProduct", "ProductId"), ("DimProduct", "ProductName")]
    return (
        evaluate(star, measures, keys)
        .orderBy(F.col("`Product Revenue`").desc_nulls_last(), "ProductId")
        .limit(n)
    )


def category_matrix(star: Star) -> DataFrame:
    return evaluate(
        star,
        [
            "Product Revenue", "Product Gross Profit", "Product Gross Margin %", "Units Sold",
            "Return Rate", "Average Rating",
        ],
        [CATEGORY, ("DimProduct", "SubcategoryName")],
    )


def campaign_matrix(star: Star) -> DataFrame:
    return evaluate(
        star,
        [
            "Campaign Audience", "Campaign CTR %", "Campaign Conversion %", "Attributed Orders",
            "Attributed Revenue", "Attributed Gross Profit", "Campaign Profit per Conversion",
        ],
        [("DimPromotion", "PromotionName"), ("DimPromotion", "PromotionType")],
    )


def on_time_trend(star: Star) -> DataFrame:
    return evaluate(star, ["On-Time Delivery %"], [MONTH])


def carrier_region_sla(star: Star, filters: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(
        star,
        ["Delivered Orders", "On-Time Delivery %", "Average Delivery Days", "Late Deliveries"],
        [("FactOrders", "Carrier"), REGION],
        filters,
    )


def return_reasons(star: Star) -> DataFrame:
    return evaluate(
        star, ["Return Refund Amount", "Return Event Units"], [("FactReturns", "ReturnReason")]
    )


def rating_behavior(star: Star) -> DataFrame:
    return evaluate(star, ["Reviews", "Reviewed Item Return Rate"], [("FactReviews", "Rating")])


def product_exceptions(star: Star, min_units: int = 100) -> DataFrame:
    """Products with enough units to judge: returns, refunds and low ratings."""
    table = evaluate(
        star,
        [
            "Units Sold", "Product Revenue", "Return Rate", "Product Refund Amount",
            "Average Rating", "Low Rating Review %",
        ],
        [("DimProduct", "ProductName")],
    )
    return table.filter(F.col("`Units Sold`") >= min_units)
