"""Returns, reviews and delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import date_key, ratio
from orderwell.functions.scalars import count_if
from orderwell.operators.facts import (
    Tables,
    accepted_returns,
    customer_segments,
    order_facts,
    product_names,
)


def return_analysis(t: Tables) -> DataFrame:
    """Grain: returned order item, rejected returns included."""
    items = t["order_items"].select("OrderItemId", "ProductId", "Quantity")
    goods = product_names(t).select(
        "ProductId", "ProductName", "BrandName", "SubcategoryName", "CategoryName"
    )
    return (
        t["returns"]
        .join(t["return_items"], "ReturnId")
        .join(items, "OrderItemId")
        .join(goods, "ProductId")
        .select(
            "ReturnId", "OrderId", "ReturnDate", "ReturnReason", "ReturnStatus", "OrderItemId",
            "ProductId", "ProductName", "BrandName", "SubcategoryName", "CategoryName",
            "ReturnQuantity", "RefundAmount",
            F.col("Quantity").alias("PurchasedQuantity"),
            ratio("ReturnQuantity", "Quantity").alias("LineReturnRate"),
        )
    )


def return_facts(t: Tables) -> DataFrame:
    """Return lines with the keys of their order: date, customer, product, channel."""
    orders = t["orders"].select(
        "OrderId", "CustomerId", "ChannelId", "PromotionId", "ShippingAddressId",
        date_key(F.col("OrderDate").cast("date")).alias("OrderDateKey"),
    )
    items = t["order_items"].select("OrderItemId", "OrderId", "ProductId", "Quantity")
    return (
        t["returns"]
        .join(t["return_items"], "ReturnId")
        .join(items, ["OrderItemId", "OrderId"])
        .join(orders, "OrderId")
        .withColumns(
            {
                "ReturnDateKey": date_key("ReturnDate"),
                "LineReturnRate": ratio("ReturnQuantity", "Quantity"),
            }
        )
    )


def review_facts(t: Tables, count_rejected: bool = True) -> DataFrame:
    """Reviews with WasReturned, by any return line or by accepted ones only."""
    returned = t["return_items"] if count_rejected else accepted_returns(t)
    flags = returned.select("OrderItemId", F.lit(1).alias("WasReturned")).distinct()
    return (
        t["product_reviews"]
        .join(flags, "OrderItemId", "left")
        .withColumns(
            {
                "WasReturned": F.coalesce("WasReturned", F.lit(0)),
                "ReviewDateKey": date_key(F.col("ReviewDate").cast("date")),
            }
        )
    )


def review_analytics(t: Tables) -> DataFrame:
    """Grain: review, with customer segment and product names."""
    goods = product_names(t).select(
        "ProductId", "SKU", "ProductName", "BrandName", "SubcategoryName", "CategoryName"
    )
    return (
        review_facts(t)
        .join(customer_segments(t).select("CustomerId", "SegmentName"), "CustomerId")
        .join(goods, "ProductId")
        .select(
            "ReviewId", "ReviewDate", "CustomerId", "SegmentName", *goods.columns, "Rating",
            "ReviewTitle", "IsVerifiedPurchase", "HelpfulVotes", "WasReturned",
        )
    )


def rating_returns(t: Tables) -> DataFrame:
    """Returns seen at each rating; rejected returns do not count here."""
    return (
        review_facts(t, count_rejected=False)
        .groupBy("Rating")
        .agg(
            F.count(F.lit(1)).alias("Reviews"),
            F.sum("WasReturned").alias("ReturnedReviews"),
            ratio(F.sum("WasReturned"), F.count(F.lit(1))).alias("ReturnRate"),
        )
    )


def _lanes(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("DeliveredDate").isNotNull())
        .groupBy("Carrier", "Region")
        .agg(
            F.count(F.lit(1)).alias("DeliveredOrders"),
            ratio(F.sum("DeliveryDays"), F.count("DeliveryDays")).alias("AvgDeliveryDays"),
            # Day counts are few distinct values, so the exact median is cheap.
            F.median("DeliveryDays").alias("MedianDeliveryDays"),
            ratio(F.sum("IsOnTime"), F.count("IsOnTime")).alias("OnTimeRate"),
            count_if(F.col("IsOnTime") == 0).alias("LateOrders"),
        )
    )


def delivery_risk(t: Tables, min_orders: int = 100) -> DataFrame:
    """Carrier and region lanes of enough deliveries, worst service first."""
    everything = Window.partitionBy(F.lit(0))  # lanes: carriers times regions
    lanes = _lanes(order_facts(t, geography=True, shipment=True))
    risk = F.rank().over(
        everything.orderBy(F.col("OnTimeRate").asc(), F.col("AvgDeliveryDays").desc())
    )
    return (
        lanes.drop("MedianDeliveryDays")
        .filter(F.col("DeliveredOrders") >= min_orders)
        .withColumn("ServiceRiskRank", risk)
        .orderBy("ServiceRiskRank", "Carrier", "Region")
    )


def delivery_performance(t: Tables) -> DataFrame:
    """All lanes of valid orders, with the median."""
    lanes = _lanes(order_facts(t, geography=True, shipment=True, only_valid=True))
    return lanes.withColumnRenamed("AvgDeliveryDays", "AverageDeliveryDays")
