"""Campaign funnel and attribution, discount effect, acquisition sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import ratio, sum_money, zero_if_null
from orderwell.functions.scalars import count_if
from orderwell.operators.facts import Tables, valid_orders

REACHED = ("Sent", "Impression")


def campaign_performance(t: Tables) -> DataFrame:
    """Grain: promotion.  Attribution is by the order's promotion, not causal."""
    kind = F.col("InteractionType")
    # One row per promotion and customer: audience is then a plain count and a
    # campaign holding most interactions is spread over its customers.
    per_customer = (
        t["campaign_interactions"]
        .groupBy("PromotionId", "CustomerId")
        .agg(
            F.max(kind.isin(*REACHED).cast("int")).alias("reached"),
            count_if(kind == "Click").alias("clicks"),
            count_if(kind == "Conversion").alias("conversions"),
        )
    )
    funnel = per_customer.groupBy("PromotionId").agg(
        F.sum("reached").alias("Audience"),
        F.sum("clicks").alias("Clicks"),
        F.sum("conversions").alias("Conversions"),
    )
    attributed = (
        valid_orders(t)
        .filter(F.col("PromotionId").isNotNull())
        .groupBy("PromotionId")
        .agg(
            F.count(F.lit(1)).alias("AttributedOrders"),
            sum_money("NetRevenue").alias("AttributedRevenue"),
            sum_money("RevenueAfterRefund").alias("AttributedRevenueAfterRefund"),
            sum_money("GrossProfit").alias("AttributedGrossProfit"),
            sum_money("DiscountAmount").alias("DiscountCost"),
        )
    )
    measures = [c for c in funnel.columns + attributed.columns if c != "PromotionId"]
    return (
        t["promotions"]
        .join(funnel, "PromotionId", "left")
        .join(attributed, "PromotionId", "left")
        .withColumns({c: zero_if_null(c) for c in measures})
        .withColumns(
            {
                "ClickThroughRate": ratio("Clicks", "Audience"),
                "ClickToConversionRate": ratio("Conversions", "Clicks"),
            }
        )
    )


def campaign_economics(t: Tables) -> DataFrame:
    """Funnel with profit per discount unit and profit rank."""
    everything = Window.partitionBy(F.lit(0))  # one row per promotion
    return (
        campaign_performance(t)
        .select(
            "PromotionCode", "PromotionName", "Audience", "Clicks", "Conversions",
            "ClickThroughRate", "ClickToConversionRate", "AttributedOrders",
            "AttributedRevenueAfterRefund", "AttributedGrossProfit", "DiscountCost",
            ratio("AttributedGrossProfit", "DiscountCost").alias("GrossProfitPerDiscountDollar"),
            F.dense_rank()
            .over(everything.orderBy(F.col("AttributedGrossProfit").desc()))
            .alias("CampaignProfitRank"),
        )
        .orderBy("CampaignProfitRank", "PromotionCode")
    )


def discount_effectiveness(orders: DataFrame) -> DataFrame:
    """Grain: month, channel and promotion group of the valid orders passed in."""
    promoted = F.when(F.col("PromotionId").isNotNull(), "Promotion").otherwise("No Promotion")
    return (
        orders.withColumns(
            {"MonthStart": F.trunc("OrderDate", "MM"), "PromotionGroup": promoted}
        )
        .groupBy("MonthStart", "ChannelName", "PromotionGroup")
        .agg(
            F.count(F.lit(1)).alias("Orders"),
            ratio(F.sum("NetRevenue"), F.count("NetRevenue")).alias("AverageOrderValue"),
            F.sum("RevenueAfterRefund").alias("RevenueAfterRefund"),
            F.sum("GrossProfit").alias("GrossProfit"),
            F.sum("DiscountAmount").alias("DiscountCost"),
        )
        .withColumn("GrossProfitPerOrder", ratio("GrossProfit", "Orders"))
    )


def discount_comparison(t: Tables) -> DataFrame:
    """Grain: month and channel, promoted beside not promoted."""
    promoted = F.col("PromotionGroup") == "Promotion"
    return (
        discount_effectiveness(valid_orders(t))
        .groupBy("MonthStart", "ChannelName")
        .agg(
            F.sum(F.when(promoted, F.col("Orders")).otherwise(0)).alias("PromotionOrders"),
            F.sum(F.when(~promoted, F.col("Orders")).otherwise(0)).alias("NonPromotionOrders"),
            F.max(F.when(promoted, F.col("AverageOrderValue"))).alias("PromotionAOV"),
            F.max(F.when(~promoted, F.col("AverageOrderValue"))).alias("NonPromotionAOV"),
            F.sum(F.when(promoted, F.col("GrossProfit")).otherwise(0)).alias(
                "PromotionGrossProfit"
            ),
            F.sum(F.when(promoted, F.col("DiscountCost")).otherwise(0)).alias(
                "PromotionDiscountCost"
            ),
        )
        .orderBy("MonthStart", "ChannelName")
    )


def acquisition_performance(t: Tables) -> DataFrame:
    """Grain: acquisition source, kept with zeros when it sold nothing.

    Orders are summed per customer before they meet the customer table.
    """
    per_customer = (
        valid_orders(t, repeat=True)
        .groupBy("CustomerId")
        .agg(
            F.count(F.lit(1)).alias("Orders"),
            sum_money("RevenueAfterRefund").alias("RevenueAfterRefund"),
            sum_money("GrossProfit").alias("GrossProfit"),
            sum_money("NetRevenue").alias("NetRevenue"),
            F.sum("IsRepeatPurchase").alias("RepeatOrders"),
        )
    )
    sources = t["customers"].select("CustomerId", "AcquisitionSource")
    sums = ["Orders", "RevenueAfterRefund", "GrossProfit", "NetRevenue", "RepeatOrders"]
    sold = (
        per_customer.join(sources, "CustomerId")
        .groupBy("AcquisitionSource")
        .agg(F.count(F.lit(1)).alias("Customers"), *[F.sum(c).alias(c) for c in sums])
    )
    acquired = sources.groupBy("AcquisitionSource").agg(
        F.count(F.lit(1)).alias("AcquiredCustomers")
    )
    merged = sold.join(acquired, "AcquisitionSource", "full")
    return merged.select(
        "AcquisitionSource",
        *[zero_if_null(c).alias(c) for c in ["Customers", *sums, "AcquiredCustomers"]],
    ).select(
        "AcquisitionSource",
        "Customers",
        "Orders",
        "RevenueAfterRefund",
        "GrossProfit",
        F.coalesce(ratio("NetRevenue", "Orders"), F.lit(0.0)).alias("AverageOrderValue"),
        "RepeatOrders",
        "AcquiredCustomers",
        ratio("Customers", "AcquiredCustomers").alias("PurchaserConversionRate"),
        ratio("RevenueAfterRefund", "Customers").alias("RevenuePerPurchaser"),
        ratio("RepeatOrders", "Orders").alias("RepeatOrderRate"),
    )
