"""Product performance, portfolio ranks and category exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import ratio, sum_money, zero_if_null
from orderwell.functions.ordered import Ordering, order_globally
from orderwell.operators.facts import Tables, line_facts, product_names
from orderwell.operators.validation import at_least, between


def product_performance(t: Tables) -> DataFrame:
    """Grain: product sold in a valid order.  Names join after the aggregation."""
    lines = line_facts(t, only_valid=True)
    # Lines of one order and product first: the distinct order count is then a
    # row count, and a product holding much of the data is spread by order.
    per_order = lines.groupBy("ProductId", "OrderId").agg(
        F.sum("Quantity").alias("UnitsSold"),
        sum_money("GrossRevenue").alias("GrossRevenue"),
        sum_money("DiscountAmount").alias("DiscountAmount"),
        sum_money("NetRevenue").alias("NetRevenue"),
        sum_money("RevenueAfterRefund").alias("RevenueAfterRefund"),
        sum_money("GrossProfit").alias("GrossProfit"),
        F.sum("ReturnedQuantity").alias("ReturnedUnits"),
        sum_money("RefundAmount").alias("RefundAmount"),
    )
    sums = [c for c in per_order.columns if c not in ("ProductId", "OrderId")]
    sold = per_order.groupBy("ProductId").agg(
        F.count(F.lit(1)).alias("Orders"), *[F.sum(c).alias(c) for c in sums]
    )
    rated = (
        t["product_reviews"]
        .groupBy("ProductId")
        .agg(F.count(F.lit(1)).alias("Reviews"), F.sum("Rating").alias("__stars"))
    )
    names = product_names(t).select(
        "ProductId", "SKU", "ProductName", "BrandName", "SubcategoryName", "CategoryName"
    )
    return (
        sold.join(names, "ProductId")
        .join(rated, "ProductId", "left")
        .select(
            *names.columns,
            "Orders",
            *sums,
            zero_if_null("Reviews").alias("Reviews"),
            ratio("__stars", "Reviews").alias("AverageRating"),
            ratio("GrossProfit", "NetRevenue").alias("GrossMarginRate"),
            ratio("ReturnedUnits", "UnitsSold").alias("UnitReturnRate"),
            ratio("DiscountAmount", "GrossRevenue").alias("DiscountRate"),
        )
    )


def product_ranking(
    t: Tables, category: str | None = None, min_orders: int = 25, top_n: int = 25
) -> DataFrame:
    """Best sellers with their revenue and profit rank inside the category."""
    at_least(min_orders, 1, "min_orders")
    between(top_n, 1, 500, "top_n")
    chosen = product_performance(t).filter(F.col("Orders") >= min_orders)
    if category is not None:
        chosen = chosen.filter(F.col("CategoryName") == category)
    ranked = order_globally(
        chosen,
        "ProductId",
        [Ordering("GrossProfit", descending=True, dense_rank="ProfitRankInCategory")],
        group="CategoryName",
    )
    top = ranked.orderBy(F.col("NetRevenue").desc(), "ProductId").limit(top_n)
    # Every product that outsells a kept one is kept too, so revenue ranks may
    # be taken over the at most 500 rows left.
    by_revenue = F.col("NetRevenue").desc()
    overall = Window.partitionBy(F.lit(0)).orderBy(by_revenue, "ProductId")
    inside = Window.partitionBy("CategoryName").orderBy(by_revenue)
    return top.withColumns(
        {
            "RevenueRankInCategory": F.dense_rank().over(inside),
            "OverallRevenueRowNumber": F.row_number().over(overall),
        }
    ).orderBy(by_revenue, "ProductId")


def product_portfolio(t: Tables, min_orders: int = 25, top: int = 5) -> DataFrame:
    """Leaders by revenue or profit in each category, with their return-quality place."""
    chosen = product_performance(t).filter(F.col("Orders") >= min_orders)
    ranked = order_globally(
        chosen.select(
            "CategoryName", "ProductId", "ProductName", "Orders", "UnitsSold", "NetRevenue",
            "GrossProfit", "GrossMarginRate", "UnitReturnRate", "AverageRating",
        ),
        "ProductId",
        [
            Ordering("NetRevenue", descending=True, dense_rank="RevenueRank"),
            Ordering("GrossProfit", descending=True, dense_rank="ProfitRank"),
            Ordering("UnitReturnRate", row_number="ReturnQualityRowNumber"),
        ],
        group="CategoryName",
    )
    return ranked.filter((F.col("RevenueRank") <= top) | (F.col("ProfitRank") <= top)).orderBy(
        "CategoryName", "RevenueRank", "ProfitRank", "ProductId"
    )


def category_performance(t: Tables) -> DataFrame:
    """Products summed to categories.

    Orders adds up each product's distinct orders, so an order with several
    products of one category counts once per product.
    """
    sums = [
        "Orders", "UnitsSold", "NetRevenue", "RevenueAfterRefund", "GrossProfit", "ReturnedUnits",
        "RefundAmount", "DiscountAmount",
    ]
    return (
        product_performance(t)
        .groupBy("CategoryName")
        .agg(F.count(F.lit(1)).alias("Products"), *[F.sum(c).alias(c) for c in sums])
        .withColumns(
            {
                "GrossMarginRate": ratio("GrossProfit", "NetRevenue"),
                "UnitReturnRate": ratio("ReturnedUnits", "UnitsSold"),
                "RefundToRevenueRate": ratio("RefundAmount", "NetRevenue"),
            }
        )
    )


def category_returns(t: Tables) -> DataFrame:
    """Return and refund exposure of categories, ranked by refunds."""
    everything = Window.partitionBy(F.lit(0))  # categories: a two-byte key bounds them
    return (
        category_performance(t)
        .select(
            "CategoryName", "UnitsSold", "ReturnedUnits", "RefundAmount", "NetRevenue",
            "GrossProfit", "UnitReturnRate", "RefundToRevenueRate",
            F.rank()
            .over(everything.orderBy(F.col("RefundAmount").desc()))
            .alias("RefundExposureRank"),
        )
        .orderBy("RefundExposureRank", "CategoryName")
    )
