"""Order-line and order facts: the two relations every metric starts from.

Lines and returns are each aggregated to the order before they meet, so nothing
fans out.  Cancelled orders stay, with gross, discount and refund intact but
zero net revenue, cost and profit.  Descriptive joins are optional: a caller
asks only for the attributes it groups by.  The joins are inner on foreign keys
the quality checks guard, so leaving one out does not change which rows exist.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.functions import date_key, money, month_start, ratio, sum_money, times, zero_if_null
from orderwell.functions.sequence import HOT_FLOOR, first_orders, neighbour_dates, number_orders
from orderwell.session import materialize

Tables = Mapping[str, DataFrame]

CANCELLED = "Cancelled"
REJECTED = "Rejected"

GEOGRAPHY = ["City", "StateProvince", "Region", "CountryCode"]


def is_valid() -> Column:
    return F.col("StatusName") != F.lit(CANCELLED)


def small(dimension: DataFrame) -> DataFrame:
    """Broadcast a dimension whose key type bounds it (one- or two-byte keys)."""
    return F.broadcast(dimension)


def assert_unique(dimension: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once: a non-empty result breaks many-to-one joins.

    ``quality.keys.many_to_one`` is the join that does not let them through.
    """
    return (
        dimension.groupBy(*key).agg(F.count(F.lit(1)).alias("Copies")).filter(F.col("Copies") > 1)
    )


# ------------------------------------------------------------------ lookups


def order_headers(t: Tables) -> DataFrame:
    """Orders with status and channel names, before any line is looked at."""
    statuses = small(t["order_statuses"].select("StatusId", "StatusName"))
    channels = small(t["sales_channels"].select("ChannelId", "ChannelName"))
    return (
        t["orders"]
        .join(statuses, "StatusId")
        .join(channels, "ChannelId")
        .select(
            "OrderId",
            F.col("OrderDate").alias("OrderDateTime"),
            F.col("OrderDate").cast("date").alias("OrderDate"),
            "CustomerId",
            "ShippingAddressId",
            "ChannelId",
            "ChannelName",
            "StatusName",
            "PromotionId",
            "PromoCode",
            "ShippingAmount",
            "TaxAmount",
        )
    )


def customer_segments(t: Tables) -> DataFrame:
    segments = small(t["customer_segments"].select("SegmentId", "SegmentName"))
    return t["customers"].join(segments, "SegmentId").drop("SegmentId")


def category_names(t: Tables) -> DataFrame:
    """Each category with its parent's name: a one-level self-join."""
    child = t["categories"].select(
        "CategoryId", F.col("CategoryName").alias("SubcategoryName"), "ParentCategoryId"
    )
    parent = t["categories"].select(
        F.col("CategoryId").alias("ParentCategoryId"), "CategoryName"
    )
    return child.join(small(parent), "ParentCategoryId", "left")


def product_names(t: Tables) -> DataFrame:
    """Products with the flattened category hierarchy."""
    return t["products"].join(small(category_names(t)), "CategoryId")


def accepted_returns(t: Tables) -> DataFrame:
    """Return lines that count: those of returns not rejected."""
    if isinstance(t, SharedOrders):
        return t.accepted_returns()
    accepted = t["returns"].filter(F.col("ReturnStatus") != REJECTED).select("ReturnId", "OrderId")
    return t["return_items"].join(accepted, "ReturnId")


def returns_by_line(t: Tables) -> DataFrame:
    return (
        accepted_returns(t)
        .groupBy("OrderItemId")
        .agg(
            F.sum("ReturnQuantity").alias("ReturnedQuantity"),
            sum_money("RefundAmount").alias("RefundAmount"),
        )
    )


def returns_by_order(t: Tables) -> DataFrame:
    return (
        accepted_returns(t)
        .groupBy("OrderId")
        .agg(
            F.sum("ReturnQuantity").alias("ReturnedUnits"),
            sum_money("RefundAmount").alias("RefundAmount"),
        )
    )


def lines_by_order(t: Tables) -> DataFrame:
    return (
        t["order_items"]
        .groupBy("OrderId")
        .agg(
            F.sum("Quantity").alias("Units"),
            sum_money(times("Quantity", "UnitPrice")).alias("GrossRevenue"),
            sum_money("DiscountAmount").alias("DiscountAmount"),
            sum_money(times("Quantity", "UnitCost")).alias("COGS"),
        )
    )


def first_valid_orders(t: Tables) -> DataFrame:
    return first_orders(order_headers(t).filter(is_valid()))


# -------------------------------------------------------------------- facts


def order_facts(
    t: Tables,
    *,
    repeat: bool = False,
    sequence: bool = False,
    segment: bool = False,
    geography: bool = False,
    promotion: bool = False,
    shipment: bool = False,
    only_valid: bool = False,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """One row per order that has lines, with the attributes asked for.

    ``repeat`` adds IsRepeatPurchase from each customer's first valid order, a
    plain aggregate.  ``sequence`` adds the full CustomerOrderNumber as well.
    """
    if isinstance(t, SharedOrders) and not sequence:
        facts = t.order_facts()
        facts = facts.filter(is_valid()) if only_valid else facts
    else:
        facts = _order_totals(t, sequence, only_valid, hot_floor)
    if repeat and not sequence:
        firsts = first_valid_orders(t).select("OrderId", F.lit(True).alias("__first"))
        facts = facts.join(firsts, "OrderId", "left").withColumn(
            "IsRepeatPurchase", F.when(is_valid() & F.col("__first").isNull(), 1).otherwise(0)
        )
        facts = facts.drop("__first")
    if shipment:
        facts = _with_shipment(facts, t)
    if segment:
        facts = facts.join(customer_segments(t).select("CustomerId", "SegmentName"), "CustomerId")
    if geography:
        places = t["addresses"].select(F.col("AddressId").alias("ShippingAddressId"), *GEOGRAPHY)
        facts = facts.join(places, "ShippingAddressId")
    if promotion:
        names = t["promotions"].select("PromotionId", "PromotionName")
        facts = facts.join(names, "PromotionId", "left")
    return facts


def _order_totals(t: Tables, sequence: bool, only_valid: bool, hot_floor: int) -> DataFrame:
    """Order headers with the sums of their lines and returns."""
    heads = order_headers(t)
    if sequence:
        heads = number_orders(heads, is_valid(), floor=hot_floor).withColumn(
            "IsRepeatPurchase",
            F.when(is_valid() & (F.col("CustomerOrderNumber") > 1), 1).otherwise(0),
        )
    if only_valid:
        heads = heads.filter(is_valid())

    facts = heads.join(lines_by_order(t), "OrderId").join(returns_by_order(t), "OrderId", "left")
    booked = F.when(is_valid(), F.col("GrossRevenue") - F.col("DiscountAmount")).otherwise(0)
    cost = F.when(is_valid(), F.col("COGS")).otherwise(0)
    facts = facts.withColumns(
        {
            "ReturnedUnits": zero_if_null("ReturnedUnits"),
            "RefundAmount": money(zero_if_null("RefundAmount")),
        }
    )
    refund = F.when(is_valid(), F.col("RefundAmount")).otherwise(0)
    return facts.withColumns(
        {
            "GrossRevenue": money("GrossRevenue"),
            "DiscountAmount": money("DiscountAmount"),
            "NetRevenue": money(booked),
            "RevenueAfterRefund": money(booked - refund),
            "GrossProfit": money(booked - cost),
            "GrossProfitAfterRefund": money(booked - cost - refund),
        }
    ).drop("COGS")


class SharedOrders(Mapping):
    """The same tables, for a caller that builds several relations on them: order facts and accepted returns are written once."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self._facts: DataFrame | None = None
        self._returns: DataFrame | None = None

    def order_facts(self) -> DataFrame:
        if self._facts is None:
            self._facts = materialize(_order_totals(self, sequence=False, only_valid=False, hot_floor=HOT_FLOOR))
        return self._facts

    def accepted_returns(self) -> DataFrame:
        if self._returns is None:
            columns = ["OrderItemId", "ReturnQuantity", "RefundAmount", "OrderId"]
            self._returns = materialize(accepted_returns(self.tables).select(*columns))
        return self._returns

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def _with_shipment(facts: DataFrame, t: Tables) -> DataFrame:
    shipments = t["shipments"].select(
        "OrderId",
        "Carrier",
        F.col("ShippedDate").cast("date").alias("ShippedDate"),
        "PromisedDeliveryDate",
        F.col("DeliveredDate").cast("date").alias("DeliveredDate"),
    )
    return facts.join(shipments, "OrderId", "left").withColumns(
        {
            "DeliveryDays": F.date_diff("DeliveredDate", "OrderDate"),
            # NULL while undelivered: the comparison is NULL then.
            "IsOnTime": (F.col("DeliveredDate") <= F.col("PromisedDeliveryDate")).cast("int"),
        }
    )


ORDER_SUMMARY_COLUMNS = [
    "OrderId", "OrderDateTime", "OrderDate", "OrderDateKey", "CustomerId", "CustomerOrderNumber",
    "IsRepeatPurchase", "SegmentName", "ChannelId", "ChannelName", "StatusName", *GEOGRAPHY,
    "Units", "GrossRevenue", "DiscountAmount", "NetRevenue", "RevenueAfterRefund", "GrossProfit",
    "GrossProfitAfterRefund", "ShippingAmount", "TaxAmount", "PromotionId", "PromoCode",
    "PromotionName", "ReturnedUnits", "RefundAmount", "Carrier", "ShippedDate",
    "PromisedDeliveryDate", "DeliveredDate", "DeliveryDays", "IsOnTime",
]


def order_summary(t: Tables, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """Grain: one order.  All attributes, including the customer order number."""
    facts = order_facts(
        t,
        sequence=True,
        segment=True,
        geography=True,
        promotion=True,
        shipment=True,
        hot_floor=hot_floor,
    )
    return facts.withColumn("OrderDateKey", date_key("OrderDate")).select(*ORDER_SUMMARY_COLUMNS)


def order_neighbours(t: Tables, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """Valid orders that have lines, with the same customer's adjacent order dates."""
    valid = order_headers(t).filter(is_valid()).select(
        "OrderId", "CustomerId", "OrderDateTime", "OrderDate"
    )
    sold = valid.join(t["order_items"].select("OrderId"), "OrderId", "left_semi")
    return neighbour_dates(sold, hot_floor).withColumn(
        "GapDays", F.date_diff("OrderDate", "PreviousOrderDate")
    )


def line_facts(
    t: Tables,
    *,
    customer: bool = False,
    geography: bool = False,
    product: bool = False,
    promotion: bool = False,
    only_valid: bool = False,
    places: DataFrame | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per order item with booked and after-refund economics.

    What belongs to the order joins the order, before any line is moved: the
    customer, the address (or ``places``, another table by ShippingAddressId)
    and the promotion.  Lines meet their returns and product while they are
    narrow, and the order last.  ``lines`` are order items that have met their
    returns already.
    """
    heads = order_headers(t)
    if only_valid:
        heads = heads.filter(is_valid())
    if customer:
        people = customer_segments(t).select(
            "CustomerId",
            F.concat_ws(" ", "FirstName", "LastName").alias("CustomerName"),
            "AcquisitionSource",
            "SegmentName",
        )
        heads = heads.join(people, "CustomerId")
    if geography:
        addresses = t["addresses"].select(F.col("AddressId").alias("ShippingAddressId"), *GEOGRAPHY)
        heads = heads.join(addresses, "ShippingAddressId")
    if places is not None:
        heads = heads.join(places, "ShippingAddressId")
    if promotion:
        names = t["promotions"].select("PromotionId", "PromotionName")
        heads = heads.join(names, "PromotionId", "left")
    facts = t["order_items"].join(returns_by_line(t), "OrderItemId", "left") if lines is None else lines
    if product:
        goods = product_names(t).select(
            "ProductId", "SKU", "ProductName", "BrandName", "SubcategoryName", "CategoryName"
        )
        facts = facts.join(goods, "ProductId")
    facts = facts.join(heads, "OrderId")
    facts = facts.withColumns(
        {
            "ReturnedQuantity": zero_if_null("ReturnedQuantity"),
            "RefundAmount": money(zero_if_null("RefundAmount")),
            "GrossRevenue": money(times("Quantity", "UnitPrice")),
            "IsValidOrder": is_valid().cast("int"),
        }
    )
    booked = F.when(is_valid(), F.col("GrossRevenue") - F.col("DiscountAmount")).otherwise(0)
    cost = F.when(is_valid(), times("Quantity", "UnitCost")).otherwise(0)
    refund = F.when(is_valid(), F.col("RefundAmount")).otherwise(0)
    facts = facts.withColumns(
        {
            "NetRevenue": money(booked),
            "COGS": money(cost),
            "GrossProfit": money(booked - cost),
            "RevenueAfterRefund": money(booked - refund),
            "GrossProfitAfterRefund": money(booked - cost - refund),
            "DiscountRate": ratio("DiscountAmount", "GrossRevenue"),
        }
    )
    return facts


ORDER_LINE_COLUMNS = [
    "OrderItemId", "OrderId", "OrderDateTime", "OrderDate", "OrderDateKey", "CustomerId",
    "CustomerName", "AcquisitionSource", "SegmentName", "ChannelId", "ChannelName", "StatusName",
    *GEOGRAPHY, "ProductId", "SKU", "ProductName", "BrandName", "SubcategoryName", "CategoryName",
    "Quantity", "UnitPrice", "UnitCost", "DiscountAmount", "GrossRevenue", "NetRevenue", "COGS",
    "GrossProfit", "ReturnedQuantity", "RefundAmount", "RevenueAfterRefund",
    "GrossProfitAfterRefund", "DiscountRate", "IsValidOrder", "PromotionId", "PromoCode",
    "PromotionName",
]


def order_lines(t: Tables) -> DataFrame:
    """Grain: one order item.  All attributes.

    Lines meet the product first: where they were priced by product they need
    not move for it.  Names of categories come last: they are broadcast, and a
    line moves with the id.
    """
    goods = t["products"].select("ProductId", "SKU", "ProductName", "BrandName", "CategoryId")
    lines = t["order_items"].join(goods, "ProductId").join(returns_by_line(t), "OrderItemId", "left")
    facts = line_facts(t, customer=True, geography=True, promotion=True, lines=lines)
    facts = facts.join(small(category_names(t)), "CategoryId")
    return facts.withColumn("OrderDateKey", date_key("OrderDate")).select(*ORDER_LINE_COLUMNS)


def valid_orders(t: Tables, **attributes: bool) -> DataFrame:
    """Orders that count in every analysis, with their month."""
    return order_facts(t, only_valid=True, **attributes).withColumn(
        "MonthStart", month_start("OrderDate")
    )


def as_of_date(t: Tables) -> Column:
    """The day after the last order of any status, as a scalar."""
    return t["orders"].agg(
        F.date_add(F.max("OrderDate").cast("date"), 1).alias("AsOfDate")
    ).scalar()
