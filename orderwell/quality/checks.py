"""Data-quality checks.  Each returns the violating rows: empty means passed."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.functions import ratio, sum_money, times, zero_if_null
from orderwell.functions.quantiles import exact_quantiles
from orderwell.functions.scalars import count_if
from orderwell.operators.facts import (
    Tables,
    is_valid,
    line_facts,
    order_facts,
)
from orderwell.quality.keys import keys_and_references, label_of, references, unique_keys
from orderwell.sources.contracts import CONTRACTS, FOREIGN_KEYS, UNIQUE_KEYS

TOLERANCE = 0.01
PAID = ("Captured", "Refunded", "Partially Refunded")
NATURAL_KEYS = (("customers", "Email"), ("products", "SKU"))
METRICS = (
    "NetRevenue", "RefundAmount", "RevenueAfterRefund", "GrossProfit", "GrossProfitAfterRefund",
)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _apart(a: Column, b: Column) -> Column:
    return F.abs(a - b) > F.lit(str(TOLERANCE)).cast("decimal(3,2)")


def _counted(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("Violations")).select(
        F.lit(name).alias("CheckName"), "Violations"
    )


# ------------------------------------------------------------- structure


def duplicate_keys(t: Tables, keys: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """Per key column: how many values occur more than once, and how many are NULL."""
    chosen = keys or _key_columns()
    counted = unique_keys(t, [(table, (column,)) for table, column in chosen])
    return counted.select("CheckName", "DuplicateValues", "NullKeys")


def _key_columns() -> list[tuple[str, str]]:
    return [*((n, c.key) for n, c in CONTRACTS.items()), *NATURAL_KEYS]


def declared_keys(t: Tables) -> DataFrame:
    """Each declared unique key, of one column or several: repeated values and the rows beyond their first."""
    return unique_keys(t, UNIQUE_KEYS)


def null_profile(t: Tables, names: Iterable[str] | None = None) -> DataFrame:
    """Rows, unexpected NULLs and expected NULLs of each table, one scan each."""

    def nulls(columns: Iterable[str]) -> Column:
        flags = [count_if(F.col(c).isNull()) for c in columns]
        return reduce(Column.__add__, flags) if flags else F.lit(0).cast("bigint")

    def one(name: str) -> DataFrame:
        contract = CONTRACTS[name]
        return t[name].agg(
            F.lit(name).alias("TableName"),
            F.count(F.lit(1)).alias("Rows"),
            nulls(contract.not_null).alias("UnexpectedNulls"),
            nulls(contract.gaps).alias("ExpectedNulls"),
        )

    return _union(one(n) for n in (names or CONTRACTS))


def check_constraints(t: Tables, names: Iterable[str] | None = None) -> DataFrame:
    """Declared row rules: all rules of a table are counted in one scan.

    As in SQL, a rule that evaluates to NULL is not violated.
    """

    def one(name: str) -> DataFrame:
        rules = CONTRACTS[name].checks.items()
        counted = t[name].agg(
            *[count_if(~F.expr(rule)).alias(label) for label, rule in rules]
        )
        pairs = F.array(
            *[
                F.struct(
                    F.lit(f"{name}.{label}").alias("CheckName"), F.col(label).alias("Violations")
                )
                for label, _ in rules
            ]
        )
        return counted.select(F.inline(pairs))

    return _union(one(n) for n in (names or CONTRACTS) if CONTRACTS[n].checks)


def foreign_keys(t: Tables) -> DataFrame:
    """Child rows whose non-NULL key has no parent, per reference; each table is scanned once."""
    listed = [(f"{fk[0]}.{fk[1]}", *fk) for fk in FOREIGN_KEYS]
    return references(t, listed).select(F.col("Reference").alias("CheckName"), F.col("Orphans").alias("Violations"))


def key_checks(t: Tables) -> DataFrame:
    """``duplicate_keys``, ``declared_keys`` and ``foreign_keys`` in one aggregate, as (CheckName, Violations).

    A value that several of them look at is moved once.
    """
    columns = [(table, (column,)) for table, column in _key_columns()]
    listed = [(f"foreign_key:{fk[0]}.{fk[1]}", *fk) for fk in FOREIGN_KEYS]
    counted = keys_and_references(t, [*columns, *UNIQUE_KEYS], listed, apart=True)
    label = F.col("Label")
    named = {"duplicate_key:": (columns, "DuplicateValues"), "null_key:": (columns, "NullKeys"), "unique:": (UNIQUE_KEYS, "DuplicateValues")}
    found = [
        F.when(label.isin(*[label_of(key) for key in keys]), F.struct(F.concat(F.lit(prefix), label).alias("CheckName"), F.col(column).alias("Violations")))
        for prefix, (keys, column) in named.items()
    ]
    found.append(F.when(label.startswith("foreign_key:"), F.struct(label.alias("CheckName"), F.col("Orphans").alias("Violations"))))
    return counted.select(F.inline(F.array_compact(F.array(*found))))


def value_ranges(t: Tables) -> DataFrame:
    """Line economics and ratings inside their bounds."""
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    items = t["order_items"].agg(
        count_if(quantity <= 0).alias("quantity_positive"),
        count_if(
            (price < 0) | (F.col("UnitCost") < 0) | (F.col("DiscountAmount") < 0)
        ).alias("economics_not_negative"),
        count_if(F.col("DiscountAmount") > times(quantity, price)).alias("discount_within_gross"),
    )
    ratings = t["product_reviews"].agg(
        count_if(~F.col("Rating").between(1, 5)).alias("rating_in_range")
    )

    def unpivot(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "CheckName", "Violations")

    return unpivot(items).unionByName(unpivot(ratings))


# ----------------------------------------------------------- relationships


def orders_without_lines(t: Tables) -> DataFrame:
    return t["orders"].select("OrderId").join(
        t["order_items"].select("OrderId"), "OrderId", "left_anti"
    )


def address_owner(t: Tables) -> DataFrame:
    """Orders shipped to an address of another customer."""
    owners = t["addresses"].select(
        F.col("AddressId").alias("ShippingAddressId"), F.col("CustomerId").alias("OwnerId")
    )
    return (
        t["orders"]
        .select("OrderId", "CustomerId", "ShippingAddressId")
        .join(owners, "ShippingAddressId")
        .filter(F.col("CustomerId") != F.col("OwnerId"))
        .select("OrderId", "CustomerId", "OwnerId")
    )


def payment_reconciliation(t: Tables) -> DataFrame:
    """Orders whose settled payments differ from lines plus shipping and tax."""
    net = t["order_items"].groupBy("OrderId").agg(
        sum_money(times("Quantity", "UnitPrice") - F.col("DiscountAmount")).alias("Net")
    )
    expected = t["orders"].join(net, "OrderId").select(
        "OrderId",
        (F.col("Net") + F.col("ShippingAmount") + F.col("TaxAmount")).alias("ExpectedAmount"),
    )
    paid = (
        t["payments"]
        .filter(F.col("PaymentStatus").isin(*PAID))
        .groupBy("OrderId")
        .agg(sum_money("Amount").alias("PaidAmount"))
    )
    return expected.join(paid, "OrderId", "left").filter(
        F.col("PaidAmount").isNull() | _apart(F.col("ExpectedAmount"), F.col("PaidAmount"))
    )


def shipment_chronology(t: Tables) -> DataFrame:
    """Shipped before ordered, or delivered before shipped."""
    ordered = t["orders"].select("OrderId", "OrderDate")
    return (
        t["shipments"]
        .join(ordered, "OrderId", "left")
        .filter(
            (F.col("ShippedDate") < F.col("OrderDate"))
            | (F.col("DeliveredDate") < F.col("ShippedDate"))
        )
        .select("ShipmentId", "OrderId")
    )


def delivery_order(t: Tables) -> DataFrame:
    """How many shipments were delivered on a day before the one they were shipped on."""
    days = F.date_diff(F.col("DeliveredDate").cast("date"), F.col("ShippedDate").cast("date"))
    return t["shipments"].agg(count_if(days < 0).alias("Violations")).select(
        F.lit("delivery_not_before_shipment").alias("CheckName"), "Violations"
    )


def return_quantity(t: Tables) -> DataFrame:
    """Return lines for more units than were bought."""
    bought = t["order_items"].select("OrderItemId", "Quantity")
    return (
        t["return_items"]
        .join(bought, "OrderItemId")
        .filter(F.col("ReturnQuantity") > F.col("Quantity"))
        .select("ReturnItemId", "ReturnQuantity", "Quantity")
    )


def promotion_code(t: Tables) -> DataFrame:
    """Orders whose code and promotion key describe different campaigns."""
    codes = t["promotions"].select("PromotionId", "PromotionCode")
    stray = F.col("PromotionId").isNull() & F.col("PromoCode").isNotNull()
    # With no matching campaign the code is NULL: that comparison is not a hit.
    differs = F.col("PromotionId").isNotNull() & (
        F.coalesce("PromoCode", F.lit("")) != F.col("PromotionCode")
    )
    return (
        t["orders"]
        .select("OrderId", "PromotionId", "PromoCode")
        .join(codes, "PromotionId", "left")
        .filter(stray | differs)
        .select("OrderId", "PromoCode", "PromotionCode")
    )


def verified_review(t: Tables) -> DataFrame:
    """Verified reviews that do not fit the customer, product or date of their line."""
    line = t["order_items"].select(
        "OrderItemId", "OrderId", F.col("ProductId").alias("BoughtProductId")
    )
    order = t["orders"].select("OrderId", F.col("CustomerId").alias("BuyerId"), "OrderDate")
    return (
        t["product_reviews"]
        .filter(F.col("IsVerifiedPurchase") == 1)
        .join(line, "OrderItemId")
        .join(order, "OrderId")
        .filter(
            (F.col("CustomerId") != F.col("BuyerId"))
            | (F.col("ProductId") != F.col("BoughtProductId"))
            | (F.col("ReviewDate") < F.col("OrderDate"))
        )
        .select("ReviewId", "CustomerId", "BuyerId")
    )


def conversion_order(t: Tables) -> DataFrame:
    """Conversions without an order, or with one of another customer or campaign."""
    orders = t["orders"].select(
        "OrderId",
        F.col("CustomerId").alias("BuyerId"),
        F.col("PromotionId").alias("OrderPromotionId"),
    )
    return (
        t["campaign_interactions"]
        .filter(F.col("InteractionType") == "Conversion")
        .join(orders, "OrderId", "left")
        .filter(
            F.col("OrderId").isNull()
            | (F.col("BuyerId") != F.col("CustomerId"))
            | (F.col("OrderPromotionId") != F.col("PromotionId"))
        )
        .select("InteractionId", "OrderId")
    )


# ------------------------------------------------------------------ metrics


def grain_reconciliation(t: Tables) -> DataFrame:
    """Per metric: orders whose total differs from the sum of their lines."""
    lines = line_facts(t).groupBy("OrderId").agg(
        *[sum_money(m).alias(f"line_{m}") for m in METRICS]
    )
    both = order_facts(t).join(lines, "OrderId")
    counts = both.agg(
        *[count_if(_apart(F.col(m), F.col(f"line_{m}"))).alias(m) for m in METRICS]
    )
    return counts.unpivot([], list(METRICS), "CheckName", "Violations")


def order_sequence(t: Tables) -> DataFrame:
    """Customers whose order numbers are not 1 to n over the orders with lines."""
    number = F.col("CustomerOrderNumber")
    return (
        order_facts(t, sequence=True)
        .filter(is_valid())
        .groupBy("CustomerId", number)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("CustomerId")
        .agg(
            F.sum("n").alias("Orders"),
            F.count(F.lit(1)).alias("Numbers"),
            F.min(number).alias("Lowest"),
            F.max(number).alias("Highest"),
        )
        .filter(
            (F.col("Orders") != F.col("Numbers"))
            | (F.col("Lowest") != 1)
            | (F.col("Highest") != F.col("Orders"))
        )
    )


def refund_bounds(t: Tables) -> DataFrame:
    """After-refund revenue above booked revenue, or a negative refund."""
    return (
        order_facts(t)
        .filter(
            (F.col("RevenueAfterRefund") > F.col("NetRevenue")) | (F.col("RefundAmount") < 0)
        )
        .select("OrderId", "NetRevenue", "RevenueAfterRefund", "RefundAmount")
    )


def conversions_match_orders(t: Tables) -> DataFrame:
    """Promotions whose conversions differ from their orders of any status."""
    conversions = (
        t["campaign_interactions"]
        .filter(F.col("InteractionType") == "Conversion")
        .groupBy("PromotionId")
        .agg(F.count(F.lit(1)).alias("Conversions"))
    )
    attributed = (
        t["orders"]
        .filter(F.col("PromotionId").isNotNull())
        .groupBy("PromotionId")
        .agg(F.count(F.lit(1)).alias("AttributedOrders"))
    )
    return (
        t["promotions"]
        .select("PromotionId")
        .join(conversions, "PromotionId", "left")
        .join(attributed, "PromotionId", "left")
        .withColumns({c: zero_if_null(c) for c in ("Conversions", "AttributedOrders")})
        .filter(F.col("Conversions") != F.col("AttributedOrders"))
    )


def completeness(t: Tables) -> DataFrame:
    """Row counts and missing required keys of the two largest entities."""

    def one(entity: str, table: str, column: str) -> DataFrame:
        return t[table].agg(
            F.lit(entity).alias("Entity"),
            F.count(F.lit(1)).alias("Rows"),
            count_if(F.col(column).isNull()).alias("MissingRequiredValues"),
        )

    return one("Orders", "orders", "CustomerId").unionByName(
        one("OrderItems", "order_items", "ProductId")
    )


def outliers(t: Tables) -> DataFrame:
    """Unusual but kept: line values past q3 + 3 IQR, and deliveries over 14 days."""
    values = t["order_items"].select(
        (times("Quantity", "UnitPrice") - F.col("DiscountAmount")).alias("v")
    )
    limit = (
        exact_quantiles(values, "v", [0.25, 0.75])
        .select((F.col("q1") + (F.col("q1") - F.col("q0")) * 3).alias("upper"))
        .scalar()
    )
    high = values.agg(count_if(F.col("v").cast("double") > limit).alias("Rows")).select(
        F.lit("high_value_order_lines").alias("CheckName"), "Rows"
    )
    days = F.date_diff(F.col("DeliveredDate").cast("date"), F.col("ShippedDate").cast("date"))
    slow = t["shipments"].agg(count_if(days > 14).alias("Rows")).select(
        F.lit("delivery_over_14_days").alias("CheckName"), "Rows"
    )
    return high.unionByName(slow)


# Bands a realistic dataset stays in.
REALISM_BANDS = {
    "repeat_customer_rate": (0.60, 0.85),
    "holiday_ratio": (1.45, 3.50),
    "lines_per_order": (1.8, None),
    "shipment_coverage": (0.9, None),
}


def realism(t: Tables) -> DataFrame:
    """Behavioral ratios with the band each should be in."""
    customers = t["customers"].agg(F.count(F.lit(1))).scalar()
    items = t["order_items"].agg(F.count(F.lit(1))).scalar()
    shipments = t["shipments"].agg(F.count(F.lit(1))).scalar()
    repeat = (
        t["orders"]
        .groupBy("CustomerId")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(count_if(F.col("n") >= 2))
        .scalar()
    )
    month = F.month("OrderDate")
    orders = t["orders"].agg(
        F.count(F.lit(1)).alias("orders"),
        count_if(month.isin(11, 12)).alias("holiday"),
        count_if(month.isin(1, 2)).alias("early"),
    )
    values = orders.select(
        ratio(repeat, customers).alias("repeat_customer_rate"),
        ratio("holiday", F.greatest("early", F.lit(1))).alias("holiday_ratio"),
        ratio(items, "orders").alias("lines_per_order"),
        ratio(shipments, "orders").alias("shipment_coverage"),
    ).unpivot([], list(REALISM_BANDS), "Metric", "Value")

    def band(side: int) -> Column:
        chosen = F.lit(None).cast("double")
        for name, limits in REALISM_BANDS.items():
            chosen = F.when(F.col("Metric") == name, F.lit(limits[side])).otherwise(chosen)
        return chosen.cast("double")

    bounded = values.withColumns({"Low": band(0), "High": band(1)})
    inside = (F.col("Value") >= F.col("Low")) & (
        F.col("High").isNull() | (F.col("Value") <= F.col("High"))
    )
    return bounded.withColumn("InBand", inside.cast("int"))
