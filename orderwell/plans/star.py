"""Star schema for reporting: dimensions, facts, aggregates and their relationships."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import date_key
from orderwell.operators import concentration, customers, marketing, operations, products, sales
from orderwell.operators.facts import (
    GEOGRAPHY,
    Tables,
    line_facts,
    order_facts,
    product_names,
    valid_orders,
)
from orderwell.quality.keys import references

# Fact, its key, dimension, the dimension's key.
RELATIONSHIPS = (
    ("FactOrders", "OrderDateKey", "DimDate", "DateKey"),
    ("FactOrderLines", "OrderDateKey", "DimDate", "DateKey"),
    ("FactReturns", "ReturnDateKey", "DimDate", "DateKey"),
    ("FactReviews", "ReviewDateKey", "DimDate", "DateKey"),
    ("FactCampaignPerformance", "StartDateKey", "DimDate", "DateKey"),
    ("FactRfmSnapshot", "SnapshotDateKey", "DimDate", "DateKey"),
    ("FactOrders", "CustomerId", "DimCustomer", "CustomerId"),
    ("FactOrderLines", "CustomerId", "DimCustomer", "CustomerId"),
    ("FactReturns", "CustomerId", "DimCustomer", "CustomerId"),
    ("FactReviews", "CustomerId", "DimCustomer", "CustomerId"),
    ("FactRfmSnapshot", "CustomerId", "DimCustomer", "CustomerId"),
    ("FactOrderLines", "ProductId", "DimProduct", "ProductId"),
    ("FactReturns", "ProductId", "DimProduct", "ProductId"),
    ("FactReviews", "ProductId", "DimProduct", "ProductId"),
    ("FactOrders", "ChannelId", "DimChannel", "ChannelId"),
    ("FactOrderLines", "ChannelId", "DimChannel", "ChannelId"),
    ("FactReturns", "ChannelId", "DimChannel", "ChannelId"),
    ("FactOrders", "GeographyKey", "DimGeography", "GeographyKey"),
    ("FactOrderLines", "GeographyKey", "DimGeography", "GeographyKey"),
    ("FactReturns", "GeographyKey", "DimGeography", "GeographyKey"),
    ("FactOrders", "PromotionId", "DimPromotion", "PromotionId"),
    ("FactOrderLines", "PromotionId", "DimPromotion", "PromotionId"),
    ("FactReturns", "PromotionId", "DimPromotion", "PromotionId"),
    ("FactCampaignPerformance", "PromotionId", "DimPromotion", "PromotionId"),
)

# Table name in files, table name in the model, sort key of the file.
EXPORTS = (
    ("dim_date", "DimDate", ("DateKey",)),
    ("dim_customers", "DimCustomer", ("CustomerId",)),
    ("dim_products", "DimProduct", ("ProductId",)),
    ("dim_channels", "DimChannel", ("ChannelId",)),
    ("dim_geography", "DimGeography", ("GeographyKey",)),
    ("dim_promotions", "DimPromotion", ("PromotionId",)),
    ("fact_orders", "FactOrders", ("OrderId",)),
    ("fact_order_lines", "FactOrderLines", ("OrderItemId",)),
    ("fact_returns", "FactReturns", ("ReturnId", "OrderItemId")),
    ("fact_reviews", "FactReviews", ("ReviewId",)),
    ("campaign_performance", "FactCampaignPerformance", ("PromotionId",)),
    ("cohort_retention", "FactCohortRetention", ("CohortMonth", "MonthsSinceFirstOrder")),
    ("rfm_segments", "FactRfmSnapshot", ("CustomerId",)),
    ("acquisition_performance", "ValidationAcquisition", ("AcquisitionSource",)),
    ("category_performance", "ValidationCategory", ("CategoryName",)),
    ("delivery_performance", "ValidationDelivery", ("Carrier", "Region")),
    ("discount_effectiveness", "ValidationDiscount", ("MonthStart", "ChannelName", "PromotionGroup")),
    ("monthly_performance", "ValidationMonthly", ("MonthStart",)),
    ("pareto_curve", "ValidationPareto", ("CustomerRank",)),
    ("product_performance", "ValidationProduct", ("ProductId",)),
    ("regional_channel_performance", "ValidationRegionalChannel", ("Region", "ChannelName")),
    ("review_return_relationship", "ValidationReviewReturn", ("Rating",)),
)


def dim_geography(t: Tables) -> DataFrame:
    """Distinct places orders went to, numbered by country, region, state and city.

    Places are numbered inside their region and shifted by the regions before,
    so only the list of regions is ever put in one order.
    """
    used = order_places(t).select(*GEOGRAPHY).distinct()
    area = ["CountryCode", "Region"]
    areas = used.groupBy(*area).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy(*area).rowsBetween(Window.unboundedPreceding, -1)
    offsets = areas.select(*area, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*area).orderBy("StateProvince", "City"))
    return (
        used.withColumn("row", inside)
        .join(offsets, area)
        .select((F.col("offset") + F.col("row")).alias("GeographyKey"), *GEOGRAPHY)
    )


def order_places(t: Tables) -> DataFrame:
    """Address and place of each order that has lines."""
    sold = t["orders"].join(t["order_items"].select("OrderId"), "OrderId", "left_semi")
    ids = sold.select(F.col("ShippingAddressId").alias("AddressId")).distinct()
    return t["addresses"].join(ids, "AddressId", "left_semi").select("AddressId", *GEOGRAPHY)


def address_geography(t: Tables) -> DataFrame:
    """ShippingAddressId to GeographyKey."""
    return (
        t["addresses"]
        .join(dim_geography(t), GEOGRAPHY)
        .select(F.col("AddressId").alias("ShippingAddressId"), "GeographyKey")
    )


class Star(Mapping):
    """The 22 tables of the reporting model, each built on first use."""

    def __init__(self, tables: Tables):
        self.t = tables
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self.t)
        return self._built[name]

    def rows(self, name: str, wanted: set[str]) -> DataFrame:
        """A table holding at least the wanted columns, without joins only others need."""
        if name == "FactOrders":
            return _slim_orders(self.t, wanted)
        if name == "FactOrderLines" and "GeographyKey" not in wanted:
            return line_facts(self.t).withColumn("OrderDateKey", date_key("OrderDate"))
        if name == "FactReviews" and "WasReturned" not in wanted:
            return self.t["product_reviews"].withColumn("ReviewDateKey", date_key(F.col("ReviewDate").cast("date")))
        return self[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


SHIPMENT_COLUMNS = {
    "Carrier", "ShippedDate", "PromisedDeliveryDate", "DeliveredDate", "DeliveryDays", "IsOnTime",
}


def _slim_orders(t: Tables, wanted: set[str]) -> DataFrame:
    facts = order_facts(
        t,
        sequence="CustomerOrderNumber" in wanted,
        repeat="IsRepeatPurchase" in wanted,
        shipment=bool(wanted & SHIPMENT_COLUMNS),
    )
    if "GeographyKey" in wanted:
        facts = facts.join(address_geography(t), "ShippingAddressId")
    return facts.withColumn("OrderDateKey", date_key("OrderDate"))


def _fact_orders(t: Tables) -> DataFrame:
    facts = order_facts(t, sequence=True, shipment=True).join(
        address_geography(t), "ShippingAddressId"
    )
    return facts.withColumn("OrderDateKey", date_key("OrderDate")).select(
        "OrderId", "OrderDateKey", "OrderDate", "CustomerId", "CustomerOrderNumber",
        "IsRepeatPurchase", "ChannelId", "GeographyKey", "StatusName", "Units", "GrossRevenue",
        "DiscountAmount", "NetRevenue", "RevenueAfterRefund", "GrossProfit",
        "GrossProfitAfterRefund", "RefundAmount", "ReturnedUnits", "PromotionId", "Carrier",
        "ShippedDate", "PromisedDeliveryDate", "DeliveredDate", "DeliveryDays", "IsOnTime",
    )


def _fact_order_lines(t: Tables) -> DataFrame:
    facts = line_facts(t, places=address_geography(t))
    return facts.withColumn("OrderDateKey", date_key("OrderDate")).select(
        "OrderItemId", "OrderId", "OrderDateKey", "CustomerId", "ProductId", "Quantity",
        "UnitPrice", "UnitCost", "GrossRevenue", "DiscountAmount", "NetRevenue",
        "RevenueAfterRefund", "COGS", "GrossProfit", "GrossProfitAfterRefund",
        "ReturnedQuantity", "RefundAmount", "DiscountRate", "IsValidOrder", "ChannelId",
        "PromotionId", "GeographyKey",
    )


def _fact_returns(t: Tables) -> DataFrame:
    return operations.return_facts(t).join(address_geography(t), "ShippingAddressId").select(
        "ReturnItemId", "ReturnId", "OrderItemId", "OrderId", "ReturnDateKey", "ReturnDate",
        "OrderDateKey", "CustomerId", "ProductId", "ChannelId", "PromotionId", "GeographyKey",
        "ReturnReason", "ReturnStatus", "ReturnQuantity", "RefundAmount", "LineReturnRate",
    )


def _fact_reviews(t: Tables) -> DataFrame:
    return operations.review_facts(t, count_rejected=False).select(
        "ReviewId", "ReviewDateKey", "ReviewDate", "CustomerId", "ProductId", "OrderItemId",
        "Rating", "ReviewTitle", "ReviewText", "IsVerifiedPurchase", "HelpfulVotes",
        "WasReturned",
    )


def _dim_customer(t: Tables) -> DataFrame:
    return customers.customer_metrics(t).select(
        "CustomerId", "AcquisitionDate", "AcquisitionSource", "SegmentName", "IsActive",
        "FirstOrderDate", "LastOrderDate", "LifetimeOrders", "LifetimeRevenue",
        "LifetimeRevenueAfterRefund", "LifetimeGrossProfit", "AverageOrderValue",
        "AvgDaysBetweenOrders", "RecencyDays", "IsRepeatCustomer", "Projected12MonthRevenue",
        "LifecycleStatus",
    )


def _campaigns(t: Tables) -> DataFrame:
    return marketing.campaign_performance(t).withColumns(
        {
            "StartDateKey": date_key(F.col("StartDate").cast("date")),
            "EndDateKey": date_key(F.col("EndDate").cast("date")),
        }
    )


def _rfm(t: Tables) -> DataFrame:
    return (
        customers.rfm_snapshot(t)
        .withColumn("SnapshotDateKey", date_key("SnapshotDate"))
        .withColumnRenamed("Segment", "RfmSegment")
    )


BUILDERS = {
    "DimDate": lambda t: t["date_dimension"],
    "DimCustomer": _dim_customer,
    "DimProduct": product_names,
    "DimChannel": lambda t: t["sales_channels"],
    "DimGeography": dim_geography,
    "DimPromotion": lambda t: t["promotions"],
    "FactOrders": _fact_orders,
    "FactOrderLines": _fact_order_lines,
    "FactReturns": _fact_returns,
    "FactReviews": _fact_reviews,
    "FactCampaignPerformance": _campaigns,
    "FactCohortRetention": customers.cohort_retention,
    "FactRfmSnapshot": _rfm,
    "ValidationAcquisition": marketing.acquisition_performance,
    "ValidationCategory": products.category_performance,
    "ValidationDelivery": operations.delivery_performance,
    "ValidationDiscount": lambda t: marketing.discount_effectiveness(valid_orders(t)),
    "ValidationMonthly": sales.monthly_performance_fractions,
    "ValidationPareto": concentration.pareto_curve,
    "ValidationProduct": products.product_performance,
    "ValidationRegionalChannel": sales.region_channel,
    "ValidationReviewReturn": operations.rating_returns,
}


def date_keys(t: Tables) -> DataFrame:
    """Orders per date key and source of the key: orders, returns, reviews, campaign starts."""

    def one(source: str, name: str, day) -> DataFrame:
        return (
            t[name]
            .groupBy(date_key(day.cast("date")).alias("DateKey"))
            .agg(F.count(F.lit(1)).alias("Rows"))
            .select(F.lit(source).alias("Source"), "DateKey", "Rows")
        )

    return reduce(
        DataFrame.unionByName,
        [
            one("order", "orders", F.col("OrderDate")),
            one("return", "returns", F.col("ReturnDate")),
            one("review", "product_reviews", F.col("ReviewDate")),
            one("campaign_start", "promotions", F.col("StartDate")),
            one("campaign_end", "promotions", F.col("EndDate")),
        ],
    )


def relationship_audit(star: Mapping[str, DataFrame]) -> DataFrame:
    """Per relationship: duplicate dimension keys and fact keys without a dimension row.

    Each table of the star is computed once and all its keys are counted together.
    A NULL fact key is allowed.
    """
    used = {name for fact, _, dim, _ in RELATIONSHIPS for name in (fact, dim)}
    listed = [(f"{dim}_{fact}", fact, fact_key, dim, dim_key) for fact, fact_key, dim, dim_key in RELATIONSHIPS]
    return references({name: star[name] for name in sorted(used)}, listed).withColumnRenamed("Reference", "Relationship")
