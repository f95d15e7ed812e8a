"""A small hand-made shop: every source table from short row lists."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderwell.sources.contracts import CONTRACTS


def when(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


DEFAULTS = {
    "customers": dict(
        FirstName="A", LastName="B", Email=None, Phone=None, AcquisitionDate=day("2023-01-01"),
        AcquisitionSource="Organic", SegmentId=1, IsActive=1, CreatedAt=None,
    ),
    "addresses": dict(
        AddressType="Shipping", AddressLine1="1 St", City="C", StateProvince="S", Region="West",
        PostalCode="0", CountryCode="US", IsDefault=1,
    ),
    "products": dict(
        SKU=None, ProductName=None, BrandName="Brand", CategoryId=2, UnitCost=Decimal("4.00"),
        ListPrice=Decimal("10.00"), LaunchDate=day("2022-01-01"), IsActive=1,
    ),
    "orders": dict(
        CustomerId=1, ShippingAddressId=1, ChannelId=1, StatusId=4, PromotionId=None,
        PromoCode=None, ShippingAmount=Decimal("0.00"), TaxAmount=Decimal("0.00"),
    ),
    "order_items": dict(
        ProductId=1, Quantity=1, UnitPrice=Decimal("10.00"), UnitCost=Decimal("4.00"),
        DiscountAmount=Decimal("0.00"),
    ),
    "payments": dict(PaymentMethod="PayPal", PaymentStatus="Captured", TransactionRef="T"),
    "shipments": dict(
        Carrier="UPS", TrackingNumber="T", ShippedDate=None, PromisedDeliveryDate=None,
        DeliveredDate=None, ShippingStatus="Pending",
    ),
    "returns": dict(
        ReturnDate=day("2024-03-01"), ReturnReason="Damaged", ReturnStatus="Approved"
    ),
    "return_items": dict(ReturnQuantity=1, RefundAmount=Decimal("1.00")),
    "product_reviews": dict(
        CustomerId=1, ProductId=1, ReviewDate=when("2024-03-01"), Rating=5, ReviewTitle=None,
        ReviewText=None, IsVerifiedPurchase=1, HelpfulVotes=0,
    ),
    "campaign_interactions": dict(
        PromotionId=1, CustomerId=1, InteractionDate=when("2024-01-01"), InteractionType="Click",
        ChannelName="Email", OrderId=None,
    ),
    "promotions": dict(
        PromotionName="P", PromotionType="Percentage", DiscountValue=Decimal("5.00"),
        MinimumOrderValue=Decimal("0.00"), StartDate=when("2024-01-01"),
        EndDate=when("2024-02-01"), ChannelId=None,
    ),
}


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    fields = CONTRACTS[name].schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    filled = []
    for row in rows:
        full = {**DEFAULTS.get(name, {}), **row}
        if name == "customers" and full["Email"] is None:
            full["Email"] = f"c{full['CustomerId']}@example.com"
        if name == "products":
            full["SKU"] = full["SKU"] or f"S{full['ProductId']}"
            full["ProductName"] = full["ProductName"] or f"Product {full['ProductId']}"
        filled.append(tuple(full.get(f.name) for f in fields))
    return spark.createDataFrame(filled, schema)


def shop(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    """Tables with the given rows; lookups and unnamed parents have defaults."""
    base: dict[str, list[dict]] = {name: [] for name in CONTRACTS}
    base["customer_segments"] = [dict(SegmentId=1, SegmentName="VIP", Description=None)]
    base["sales_channels"] = [
        dict(ChannelId=1, ChannelName="Website"), dict(ChannelId=2, ChannelName="Mobile App"),
    ]
    base["order_statuses"] = [
        dict(StatusId=i, StatusName=s)
        for i, s in enumerate(("Pending", "Processing", "Shipped", "Delivered", "Cancelled"), 1)
    ]
    base["categories"] = [
        dict(CategoryId=1, CategoryName="Home", ParentCategoryId=None),
        dict(CategoryId=2, CategoryName="Kitchen", ParentCategoryId=1),
    ]
    base["customers"] = [dict(CustomerId=1)]
    base["addresses"] = [dict(AddressId=1, CustomerId=1)]
    base["products"] = [dict(ProductId=1), dict(ProductId=2)]
    base["promotions"] = [dict(PromotionId=1, PromotionCode="P1")]
    base.update(rows)
    tables = {name: table(spark, name, listed) for name, listed in base.items()}
    if not base["date_dimension"]:
        from orderwell.sources.calendar import order_calendar

        tables["date_dimension"] = order_calendar(tables["orders"])
    return tables


def one(df: DataFrame, **where):
    """The single row matching the given values."""
    found = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(found) == 1, found
    return found[0]
