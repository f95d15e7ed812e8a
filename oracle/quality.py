"""Data-quality checks q01 to q21 on seeded violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.catalog import QUERIES, query
from oracle.prelude import piece
from orderwell.quality import checks, keys, report

_KEYS = [
    ("customer_segments.SegmentId", "segments", "SegmentId"), ("customers.CustomerId", "customers", "CustomerId"),
    ("addresses.AddressId", "addresses", "AddressId"), ("categories.CategoryId", "categories", "CategoryId"),
    ("products.ProductId", "products", "ProductId"), ("sales_channels.ChannelId", "channels", "ChannelId"),
    ("order_statuses.StatusId", "statuses", "StatusId"), ("promotions.PromotionId", "promotions", "PromotionId"),
    ("orders.OrderId", "b_orders", "OrderId"), ("order_items.OrderItemId", "items", "OrderItemId"),
    ("payments.PaymentId", "dirty_payments", "PaymentId"), ("shipments.ShipmentId", "dirty_shipments", "ShipmentId"),
    ("returns.ReturnId", "b_returns", "ReturnId"), ("return_items.ReturnItemId", "return_items", "ReturnItemId"),
    ("product_reviews.ReviewId", "dirty_reviews", "ReviewId"),
    ("campaign_interactions.InteractionId", "interactions", "InteractionId"), ("date_dimension.DateKey", "calendar", "DateKey"),
    ("customers.Email", "customers", "Email"), ("products.SKU", "products", "SKU"),
]
query(
    "q01_duplicate_keys", "s: CheckName i: DuplicateValues NullKeys", " ".join(sorted({k[1] for k in _KEYS})),
    " UNION ALL ".join(
        f"SELECT '{n}' AS CheckName, COUNT(*) FILTER (v IS NOT NULL AND n > 1) AS DuplicateValues, COALESCE(SUM(n) FILTER (v IS NULL), 0) AS NullKeys"
        f" FROM (SELECT {c} AS v, COUNT(*) AS n FROM {t} GROUP BY 1)" for n, t, c in _KEYS),
    dirty=True,
)(checks.duplicate_keys)

# Duplicated on purpose: a non-unique column must be reported.
query(
    "q01b_non_unique_column", "s: CheckName i: DuplicateValues NullKeys", "b_orders", """
SELECT 'orders.CustomerId' AS CheckName, COUNT(*) FILTER (v IS NOT NULL AND n > 1) AS DuplicateValues, COALESCE(SUM(n) FILTER (v IS NULL), 0) AS NullKeys
FROM (SELECT CustomerId AS v, COUNT(*) AS n FROM b_orders GROUP BY 1)
UNION ALL SELECT 'orders.PromotionId', COUNT(*) FILTER (v IS NOT NULL AND n > 1), COALESCE(SUM(n) FILTER (v IS NULL), 0)
FROM (SELECT PromotionId AS v, COUNT(*) AS n FROM b_orders GROUP BY 1)""",
)(lambda t: checks.duplicate_keys(t, [("orders", "CustomerId"), ("orders", "PromotionId")]))


def _nulls(name: str, table: str, expected: str = "") -> str:
    some = " + ".join(f"COUNT(*) FILTER ({c} IS NULL)" for c in expected.split()) or "0"
    return f"SELECT '{name}' AS TableName, COUNT(*) AS Rows, 0 AS UnexpectedNulls, {some} AS ExpectedNulls FROM {table}"


query(
    "q02_null_profile", "s: TableName i: Rows UnexpectedNulls ExpectedNulls",
    "segments customers addresses categories products channels statuses promotions b_orders items payments shipments b_returns return_items"
    " reviews interactions calendar",
    " UNION ALL ".join(_nulls(*r) for r in [
        ("customer_segments", "segments"), ("customers", "customers"), ("addresses", "addresses"),
        ("categories", "categories", "ParentCategoryId"), ("products", "products"), ("sales_channels", "channels"),
        ("order_statuses", "statuses"), ("promotions", "promotions", "ChannelId"), ("orders", "b_orders"), ("order_items", "items"),
        ("payments", "payments"), ("shipments", "shipments", "ShippedDate PromisedDeliveryDate DeliveredDate"), ("returns", "b_returns"),
        ("return_items", "return_items"), ("product_reviews", "reviews"), ("campaign_interactions", "interactions", "OrderId"),
        ("date_dimension", "calendar")]),
)(checks.null_profile)
query(
    "q03_orders_without_lines", "i: OrderId", "", "SELECT o_orderkey AS OrderId FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    dirty=True,
)(checks.orders_without_lines)
query(
    "q04_address_owner", "i: OrderId CustomerId OwnerId", "dirty_orders addresses", """
SELECT OrderId, o.CustomerId, a.CustomerId AS OwnerId FROM dirty_orders o JOIN addresses a ON a.AddressId = ShippingAddressId AND a.CustomerId <> o.CustomerId""",
    dirty=True,
)(checks.address_owner)
query(
    "q05_payment_reconciliation", "i: OrderId f: ExpectedAmount PaidAmount", "b_orders items dirty_payments", """
WITH e AS (SELECT OrderId, SUM(Quantity * UnitPrice - DiscountAmount) AS net FROM items GROUP BY OrderId),
p AS (SELECT OrderId, SUM(Amount) AS PaidAmount FROM dirty_payments WHERE PaymentStatus <> 'Failed' GROUP BY OrderId)
SELECT OrderId, net + ShippingAmount + TaxAmount AS ExpectedAmount, PaidAmount FROM b_orders JOIN e USING (OrderId) LEFT JOIN p USING (OrderId)
WHERE PaidAmount IS NULL OR abs(net + ShippingAmount + TaxAmount - PaidAmount) > 0.01""",
    dirty=True,
)(checks.payment_reconciliation)
query(
    "q06_shipment_chronology", "i: ShipmentId OrderId", "b_orders dirty_shipments", """
SELECT ShipmentId, OrderId FROM dirty_shipments JOIN b_orders USING (OrderId)
WHERE COALESCE(ShippedDate < OrderDateTime, false) OR COALESCE(DeliveredDate < ShippedDate, false)""",
    dirty=True,
)(checks.shipment_chronology)
query(
    "q07_return_quantity", "s: ReturnItemId i: ReturnQuantity Quantity", "dirty_return_items items", """
SELECT ReturnItemId, ReturnQuantity, Quantity FROM dirty_return_items JOIN items USING (OrderItemId) WHERE ReturnQuantity > Quantity""",
    dirty=True,
)(checks.return_quantity)
query(
    "q08_promotion_code", "i: OrderId s: PromoCode PromotionCode", "dirty_orders promotions", """
SELECT OrderId, PromoCode, PromotionCode FROM dirty_orders LEFT JOIN promotions USING (PromotionId)
WHERE CASE WHEN PromotionId IS NULL THEN PromoCode IS NOT NULL ELSE COALESCE(PromoCode, '') <> PromotionCode END""",
    dirty=True,
)(checks.promotion_code)
query(
    "q09_verified_review", "s: ReviewId i: CustomerId BuyerId", "dirty_reviews items b_orders", """
SELECT ReviewId, r.CustomerId, o.CustomerId AS BuyerId FROM dirty_reviews r JOIN items i USING (OrderItemId) JOIN b_orders o ON o.OrderId = i.OrderId
WHERE IsVerifiedPurchase = 1 AND NOT (r.CustomerId = o.CustomerId AND r.ProductId = i.ProductId AND ReviewDate >= OrderDateTime)""",
    dirty=True,
)(checks.verified_review)
query(
    "q10_conversion_order", "i: InteractionId OrderId", "interactions b_orders", """
SELECT InteractionId, c.OrderId FROM interactions c LEFT JOIN b_orders o USING (OrderId)
WHERE InteractionType = 'Conversion' AND (c.OrderId IS NULL OR COALESCE(o.CustomerId <> c.CustomerId, false) OR COALESCE(o.PromotionId <> c.PromotionId, false))""",
    dirty=True,
)(checks.conversion_order)
_GRAIN = ["NetRevenue", "RefundAmount", "RevenueAfterRefund", "GrossProfit", "GrossProfitAfterRefund"]
query(
    "q11_grain_reconciliation", "s: CheckName i: Violations", "order_summary order_lines",
    "WITH l AS (SELECT OrderId, " + ", ".join(f"SUM({m}) AS l_{m}" for m in _GRAIN) + " FROM order_lines GROUP BY OrderId)"
    + " UNION ALL ".join(
        f" SELECT '{m}' AS CheckName, COUNT(*) FILTER (abs({m} - l_{m}) > 0.01) AS Violations FROM order_summary JOIN l USING (OrderId)" for m in _GRAIN),
)(checks.grain_reconciliation)
query(
    "q12_order_sequence", "i: CustomerId Orders Numbers Lowest Highest", "valid_orders", """
SELECT CustomerId, COUNT(*) AS Orders, COUNT(DISTINCT CustomerOrderNumber) AS Numbers, MIN(CustomerOrderNumber) AS Lowest, MAX(CustomerOrderNumber) AS Highest
FROM valid_orders GROUP BY CustomerId HAVING Orders <> Numbers OR Lowest <> 1 OR Highest <> Orders""",
)(checks.order_sequence)
query(
    "q13_refund_bounds", "s: CheckName i: Violations", "order_summary", """
SELECT 'refund_bounds' AS CheckName, COUNT(*) FILTER (RevenueAfterRefund > NetRevenue OR RefundAmount < 0) AS Violations FROM order_summary""",
)(lambda t: checks._counted("refund_bounds", checks.refund_bounds(t)))
query(
    "q14_conversions_match_orders", "i: PromotionId Conversions AttributedOrders", "promotions interactions b_orders", """
SELECT PromotionId, (SELECT COUNT(*) FROM interactions i WHERE i.PromotionId = p.PromotionId AND InteractionType = 'Conversion') AS Conversions,
       (SELECT COUNT(*) FROM b_orders o WHERE o.PromotionId = p.PromotionId) AS AttributedOrders
FROM promotions p WHERE Conversions <> AttributedOrders""",
)(checks.conversions_match_orders)
query(
    "q15_completeness", "s: Entity i: Rows MissingRequiredValues", "b_orders items", """
SELECT 'Orders' AS Entity, COUNT(*) AS Rows, COUNT(*) - COUNT(CustomerId) AS MissingRequiredValues FROM b_orders
UNION ALL SELECT 'OrderItems', COUNT(*), COUNT(*) - COUNT(ProductId) FROM items""",
)(checks.completeness)
query(
    "q16_foreign_keys", "s: CheckName i: Violations", "dirty_orders customers addresses items products b_returns dirty_return_items dirty_reviews", """
SELECT 'orders.CustomerId' AS CheckName, COUNT(*) FILTER (CustomerId NOT IN (SELECT CustomerId FROM customers)) AS Violations FROM dirty_orders
UNION ALL SELECT 'orders.ShippingAddressId', COUNT(*) FILTER (ShippingAddressId NOT IN (SELECT AddressId FROM addresses)) FROM dirty_orders
UNION ALL SELECT 'order_items.OrderId', COUNT(*) FILTER (OrderId NOT IN (SELECT OrderId FROM dirty_orders)) FROM items
UNION ALL SELECT 'order_items.ProductId', COUNT(*) FILTER (ProductId NOT IN (SELECT ProductId FROM products)) FROM items
UNION ALL SELECT 'return_items.ReturnId', COUNT(*) FILTER (ReturnId NOT IN (SELECT ReturnId FROM b_returns)) FROM dirty_return_items
UNION ALL SELECT 'return_items.OrderItemId', COUNT(*) FILTER (OrderItemId NOT IN (SELECT OrderItemId FROM items)) FROM dirty_return_items
UNION ALL SELECT 'product_reviews.OrderItemId', COUNT(*) FILTER (OrderItemId NOT IN (SELECT OrderItemId FROM items)) FROM dirty_reviews""",
    dirty=True,
)(checks.foreign_keys)
query(
    "q17_value_ranges", "s: CheckName i: Violations", "items reviews", """
SELECT 'quantity_positive' AS CheckName, COUNT(*) FILTER (Quantity <= 0) AS Violations FROM items
UNION ALL SELECT 'economics_not_negative', COUNT(*) FILTER (least(UnitPrice, UnitCost, DiscountAmount) < 0) FROM items
UNION ALL SELECT 'discount_within_gross', COUNT(*) FILTER (DiscountAmount > Quantity * UnitPrice) FROM items
UNION ALL SELECT 'rating_in_range', COUNT(*) FILTER (Rating NOT BETWEEN 1 AND 5) FROM reviews""",
)(checks.value_ranges)
query(
    "q18_outliers", "s: CheckName i: Rows", "items shipments", """
SELECT 'high_value_order_lines' AS CheckName,
       COUNT(*) FILTER (v > (SELECT quantile_cont(v, 0.75) + 3 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) FROM values_)) AS Rows
FROM (SELECT CAST(Quantity * UnitPrice - DiscountAmount AS DOUBLE) AS v FROM items)
UNION ALL SELECT 'delivery_over_14_days', COUNT(*) FILTER (date_diff('day', ShippedDate, DeliveredDate) > 14) FROM shipments""".replace(
        "values_", "(SELECT CAST(Quantity * UnitPrice - DiscountAmount AS DOUBLE) AS v FROM items)"),
)(checks.outliers)
query(
    "q19_check_constraints", "s: CheckName i: Violations", "items dirty_shipments", """
SELECT unnest(['customers.source_listed', 'addresses.type_listed', 'products.cost_not_negative', 'products.price_covers_cost',
  'promotions.type_listed', 'promotions.value_not_negative', 'promotions.dates_in_order', 'orders.shipping_not_negative', 'orders.tax_not_negative',
  'order_items.quantity_positive', 'order_items.price_positive', 'payments.method_listed', 'payments.status_listed', 'payments.amount_not_negative',
  'shipments.status_listed', 'returns.reason_listed', 'returns.status_listed', 'return_items.quantity_positive', 'return_items.refund_not_negative',
  'product_reviews.rating_in_range', 'product_reviews.votes_not_negative', 'campaign_interactions.type_listed', 'campaign_interactions.channel_listed'])
  AS CheckName, 0 AS Violations
UNION ALL SELECT 'order_items.discount_within_gross', COUNT(*) FILTER (DiscountAmount < 0 OR DiscountAmount > Quantity * UnitPrice) FROM items
UNION ALL SELECT 'shipments.delivered_after_shipped', COUNT(*) FILTER (DeliveredDate < ShippedDate) FROM dirty_shipments""",
    dirty=True,
)(checks.check_constraints)
piece("realism", "b_orders items shipments customers", """
SELECT 'repeat_customer_rate' AS Metric, (SELECT CAST(COUNT(*) AS DOUBLE) FROM (SELECT 1 FROM b_orders GROUP BY CustomerId HAVING COUNT(*) >= 2))
         / (SELECT COUNT(*) FROM customers) AS Value, 0.60 AS Low, 0.85 AS High
UNION ALL SELECT 'holiday_ratio', CAST(COUNT(*) FILTER (month(OrderDate) >= 11) AS DOUBLE) / COUNT(*) FILTER (month(OrderDate) <= 2), 1.45, 3.5 FROM b_orders
UNION ALL SELECT 'lines_per_order', CAST((SELECT COUNT(*) FROM items) AS DOUBLE) / COUNT(*), 1.8, NULL FROM b_orders
UNION ALL SELECT 'shipment_coverage', CAST((SELECT COUNT(*) FROM shipments) AS DOUBLE) / COUNT(*), 0.9, NULL FROM b_orders""")
query(
    "q20_realism", "s: Metric f: Value Low High i: InBand", "realism",
    "SELECT *, CAST(Value >= Low AND (High IS NULL OR Value <= High) AS INTEGER) AS InBand FROM realism",
)(checks.realism)


query(
    "q22_delivery_order", "s: CheckName i: Violations", "dirty_shipments",
    "SELECT 'delivery_not_before_shipment' AS CheckName, COUNT(*) FILTER (CAST(DeliveredDate AS DATE) < CAST(ShippedDate AS DATE)) AS Violations"
    " FROM dirty_shipments",
    dirty=True,
)(checks.delivery_order)


# What is wrong in a table on purpose: column, rows it is wrong in, wrong value, right value where the reference table lacks the column.
_WRONG = {
    "customers": [("AcquisitionSource", "CustomerId % 7 = 0", "'Nowhere'", None)],
    "addresses": [("AddressType", "AddressId % 5 = 0", "'Work'", "'Shipping'")],
    "products": [("UnitCost", "ProductId % 7 = 0", "-1", None), ("ListPrice", "ProductId % 11 = 0", "0", None)],
    "promotions": [
        ("PromotionType", "PromotionId = 3", "'Gift'", None), ("MinimumOrderValue", "PromotionId IN (4, 5)", "-1", None),
        ("EndDate", "PromotionId > 12", "StartDate", None),
    ],
    "orders": [("ShippingAmount", "OrderId % 9 = 0", "-5.99", None), ("TaxAmount", "OrderId % 8 = 0", "-0.01", None)],
    "order_items": [
        ("Quantity", "OrderId % 5 = 0", "0", None), ("UnitPrice", "ProductId % 7 = 0", "-1", None), ("DiscountAmount", "OrderId % 11 = 0", "1000000", None),
    ],
    "payments": [
        ("PaymentMethod", "OrderId % 3 = 0", "'Cash'", None), ("PaymentStatus", "OrderId % 10 = 1", "'Lost'", None), ("Amount", "OrderId % 6 = 5", "-1", None),
    ],
    "shipments": [("ShippingStatus", "OrderId % 13 = 0", "'Gone'", None), ("DeliveredDate", "OrderId % 4 = 0", "ShippedDate - INTERVAL 1 DAY", None)],
    "returns": [("ReturnReason", "OrderId % 7 = 0", "'Lost'", None), ("ReturnStatus", "OrderId % 6 = 0", "'Open'", None)],
    "return_items": [("ReturnQuantity", "RefundAmount < 300", "0", None), ("RefundAmount", "RefundAmount > 500", "-RefundAmount", None)],
    "product_reviews": [("Rating", "ProductId % 13 = 0", "9", None), ("HelpfulVotes", "HelpfulVotes = 3", "-3", None)],
    "campaign_interactions": [("InteractionType", "InteractionId % 5 = 0", "'Seen'", None), ("ChannelName", "PromotionId = 2", "'Radio'", None)],
}
# Table, name of its reference piece.
_PIECES = {key.split(".")[0]: name.removeprefix("dirty_") for key, name, _ in _KEYS}


def _wrong(t):
    """The tables with those values in them."""

    def one(name: str):
        df = t[name]
        return df.select(*[
            next((F.expr(f"CASE WHEN {rows} THEN {bad} ELSE {c} END").cast(df.schema[c].dataType).alias(c)
                  for column, rows, bad, _ in _WRONG[name] if column == c), F.col(c))
            for c in df.columns
        ])

    return {**t, **{name: one(name) for name in _WRONG}}


def _wrong_sql(name: str) -> str:
    """The reference table with the wrong values as x_ columns."""
    altered = ", ".join(f"CASE WHEN {rows} THEN {bad} ELSE {right or column} END AS x_{column}" for column, rows, bad, right in _WRONG[name])
    return f"(SELECT *, {altered} FROM {_PIECES[name]})"


def _one_of(column: str, *values: str) -> str:
    return f"NOT list_contains([{', '.join(repr(v) for v in values)}], {column})"


# Rule, when a row breaks it.
_BROKEN = {
    "customers.source_listed": _one_of("x_AcquisitionSource", "Organic", "Paid Search", "Social", "Referral", "Email", "Marketplace"),
    "addresses.type_listed": _one_of("x_AddressType", "Billing", "Shipping"),
    "products.cost_not_negative": "x_UnitCost < 0",
    "products.price_covers_cost": "x_ListPrice <= 0 OR x_ListPrice < x_UnitCost",
    "promotions.type_listed": _one_of("x_PromotionType", "Percentage", "Fixed Amount", "Free Shipping"),
    "promotions.value_not_negative": "least(DiscountValue, x_MinimumOrderValue) < 0",
    "promotions.dates_in_order": "x_EndDate <= StartDate",
    "orders.shipping_not_negative": "x_ShippingAmount < 0",
    "orders.tax_not_negative": "x_TaxAmount < 0",
    "order_items.quantity_positive": "x_Quantity <= 0",
    "order_items.price_positive": "x_UnitPrice <= 0 OR UnitCost < 0",
    "order_items.discount_within_gross": "x_DiscountAmount < 0 OR x_DiscountAmount > x_Quantity * x_UnitPrice",
    "payments.method_listed": _one_of("x_PaymentMethod", "Credit Card", "Debit Card", "PayPal", "Bank Transfer", "Gift Card"),
    "payments.status_listed": _one_of("x_PaymentStatus", "Authorized", "Captured", "Failed", "Refunded", "Partially Refunded"),
    "payments.amount_not_negative": "x_Amount < 0",
    "shipments.status_listed": _one_of("x_ShippingStatus", "Pending", "Shipped", "In Transit", "Delivered", "Exception"),
    "shipments.delivered_after_shipped": "x_DeliveredDate < ShippedDate",
    "returns.reason_listed": _one_of("x_ReturnReason", "Damaged", "Wrong Item", "Not as Described", "Changed Mind", "Too Late", "Defective"),
    "returns.status_listed": _one_of("x_ReturnStatus", "Requested", "Approved", "Received", "Refunded", "Rejected"),
    "return_items.quantity_positive": "x_ReturnQuantity <= 0",
    "return_items.refund_not_negative": "x_RefundAmount < 0",
    "product_reviews.rating_in_range": "x_Rating < 1 OR x_Rating > 5",
    "product_reviews.votes_not_negative": "x_HelpfulVotes < 0",
    "campaign_interactions.type_listed": _one_of("x_InteractionType", "Sent", "Impression", "Click", "Conversion", "Unsubscribe"),
    "campaign_interactions.channel_listed": _one_of("x_ChannelName", "Email", "Paid Social", "Display", "Push", "SMS"),
}
query(
    "q19b_every_rule_broken", "s: CheckName i: Violations", " ".join(sorted(_PIECES[name] for name in _WRONG)),
    " UNION ALL ".join(
        f"SELECT '{rule}' AS CheckName, COUNT(*) FILTER ({broken}) AS Violations FROM {_wrong_sql(rule.split('.')[0])}" for rule, broken in _BROKEN.items()),
)(lambda t: checks.check_constraints(_wrong(t)))
query(
    "q17b_ranges_broken", "s: CheckName i: Violations", "items reviews", f"""
SELECT 'quantity_positive' AS CheckName, COUNT(*) FILTER (x_Quantity <= 0) AS Violations FROM {_wrong_sql('order_items')}
UNION ALL SELECT 'economics_not_negative', COUNT(*) FILTER (least(x_UnitPrice, UnitCost, x_DiscountAmount) < 0) FROM {_wrong_sql('order_items')}
UNION ALL SELECT 'discount_within_gross', COUNT(*) FILTER (x_DiscountAmount > x_Quantity * x_UnitPrice) FROM {_wrong_sql('order_items')}
UNION ALL SELECT 'rating_in_range', COUNT(*) FILTER (x_Rating NOT BETWEEN 1 AND 5) FROM {_wrong_sql('product_reviews')}""",
)(lambda t: checks.value_ranges(_wrong(t)))
query(
    "q13b_refunds_below_zero", "i: OrderId f: RefundAmount", "b_returns return_items items", f"""
SELECT i.OrderId, SUM(x_RefundAmount) AS RefundAmount FROM {_wrong_sql('return_items')} JOIN b_returns USING (ReturnId) JOIN items i USING (OrderItemId)
WHERE ReturnStatus <> 'Rejected' GROUP BY i.OrderId HAVING SUM(x_RefundAmount) < 0""",
)(lambda t: checks.refund_bounds({**t, "return_items": _wrong(t)["return_items"]}))

# Table, column that lacks a value, rows it lacks it in.
_GAPS = [
    ("customer_segments", "SegmentName", "SegmentId = 2"), ("customers", "Email", "CustomerId % 3 = 0"), ("addresses", "City", "AddressId % 4 = 0"),
    ("categories", "CategoryName", "CategoryId > 20"), ("products", "SKU", "ProductId % 6 = 0"), ("sales_channels", "ChannelName", "ChannelId = 1"),
    ("order_statuses", "StatusName", "StatusId > 3"), ("promotions", "PromotionCode", "PromotionId < 5"), ("orders", "OrderDate", "OrderId % 5 = 0"),
    ("order_items", "Quantity", "ProductId % 8 = 0"), ("payments", "Amount", "PaymentId % 7 = 0"), ("shipments", "Carrier", "ShipmentId % 9 = 0"),
    ("returns", "ReturnDate", "OrderId % 4 = 0"), ("return_items", "RefundAmount", "RefundAmount > 400"), ("product_reviews", "Rating", "Rating = 3"),
    ("campaign_interactions", "ChannelName", "InteractionId % 2 = 0"), ("date_dimension", "MonthName", "DateKey % 10 = 0"),
]
query(
    "q02b_unexpected_nulls", "s: TableName i: UnexpectedNulls", " ".join(sorted(set(_PIECES.values()))),
    " UNION ALL ".join(f"SELECT '{name}' AS TableName, COUNT(*) AS UnexpectedNulls FROM {_PIECES[name]} WHERE {rows}" for name, _, rows in _GAPS),
)(lambda t: checks.null_profile({name: t[name].withColumn(column, F.expr(f"CASE WHEN NOT ({rows}) THEN {column} END")) for name, column, rows in _GAPS}))

# Label, reference rows, what two of them may not share.
_UNIQUE = [
    ("customer_segments.SegmentName", "segments", "SegmentName"), ("customers.Email", "customers", "Email"),
    ("categories.CategoryName", "categories", "CategoryName"), ("products.SKU", "products", "SKU"), ("sales_channels.ChannelName", "channels", "ChannelName"),
    ("order_statuses.StatusName", "statuses", "StatusName"), ("promotions.PromotionCode", "promotions", "PromotionCode"),
    ("order_items.OrderId+ProductId", "items", "row(OrderId, ProductId)"),
    ("payments.TransactionRef", "(SELECT CASE WHEN PaymentId % 17 <> 0 THEN PaymentId END AS r FROM payments)", "r"),
    ("shipments.OrderId", "(SELECT OrderId FROM shipments UNION ALL SELECT OrderId FROM shipments WHERE OrderId % 13 = 0)", "OrderId"),
    ("shipments.TrackingNumber", "shipments", "OrderId"), ("return_items.ReturnId+OrderItemId", "return_items", "row(ReturnId, OrderItemId)"),
    ("product_reviews.OrderItemId", "(SELECT * FROM reviews, range(CASE WHEN ProductId % 11 = 0 THEN 3 ELSE 1 END))", "OrderItemId"),
    ("date_dimension.FullDate", "calendar", "FullDate"),
]


def _twice(t):
    """A second shipment of some orders, two more reviews of some lines, payments without a reference."""
    again = t["shipments"].where("OrderId % 13 = 0").withColumns({
        "ShipmentId": F.expr("-ShipmentId"), "TrackingNumber": F.concat("TrackingNumber", F.lit("-2"))})
    copies = F.explode(F.expr("sequence(1, CASE WHEN ProductId % 11 = 0 THEN 3 ELSE 1 END)"))
    return {
        **t,
        "shipments": t["shipments"].unionByName(again),
        "product_reviews": t["product_reviews"].withColumn("copy", copies).drop("copy"),
        "payments": t["payments"].withColumn("TransactionRef", F.expr("CASE WHEN PaymentId % 17 <> 0 THEN TransactionRef END")),
    }


_NEEDED = "segments customers categories products channels statuses promotions items payments shipments return_items reviews calendar"
def _keys_sql(listed) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS CheckName, COUNT(*) FILTER (k IS NOT NULL AND n > 1) AS DuplicateValues, COALESCE(SUM(n - 1) FILTER (k IS NOT NULL), 0) AS SurplusRows,"
        f" COALESCE(SUM(n) FILTER (k IS NULL), 0) AS NullKeys FROM (SELECT {key} AS k, COUNT(*) AS n FROM {rows} GROUP BY ALL)" for label, rows, key in listed
    )


_COLUMNS = "s: CheckName i: DuplicateValues SurplusRows NullKeys"
query("q24_declared_keys", _COLUMNS, _NEEDED, _keys_sql(_UNIQUE))(lambda t: checks.declared_keys(_twice(t)))
_AS_THEY_ARE = {
    "payments.TransactionRef": ("payments", "PaymentId"), "shipments.OrderId": ("shipments", "OrderId"), "product_reviews.OrderItemId": ("reviews", "OrderItemId"),
}
query(
    "q24b_keys_as_they_are", _COLUMNS, _NEEDED, _keys_sql([(label, *_AS_THEY_ARE.get(label, (rows, key))) for label, rows, key in _UNIQUE]),
)(checks.declared_keys)
query(
    "q25_repeated_keys", "s: CheckName Key i: Rows", "shipments reviews", """
SELECT 'shipments.OrderId' AS CheckName, CAST(OrderId AS VARCHAR) AS Key, 2 AS Rows FROM shipments WHERE OrderId % 13 = 0
UNION ALL SELECT 'product_reviews.OrderItemId', OrderItemId, 3 FROM reviews WHERE ProductId % 11 = 0""",
)(lambda t: keys.repeated_keys(_twice(t), [("shipments", ("OrderId",)), ("product_reviews", ("OrderItemId",))]))


def _profile_sql() -> tuple[str, str]:
    nulls, outliers = QUERIES["q02_null_profile"], QUERIES["q18_outliers"]
    text = report.OUTLIERS_KEPT["high_value_order_lines"]
    parts = [
        f"SELECT '{kind}' AS Kind, TableName AS Name, {column} AS Value, NULL AS Warning FROM ({nulls.sql})"
        for kind, column in (("rows", "Rows"), ("unexpected_nulls", "UnexpectedNulls"), ("expected_nulls", "ExpectedNulls"))
    ]
    parts.append(
        "SELECT 'outliers' AS Kind, CheckName AS Name, Rows AS Value,"
        f" CASE WHEN CheckName = 'high_value_order_lines' AND Rows > 0 THEN '{text}' END AS Warning FROM ({outliers.sql})"
    )
    return " ".join(sorted({*nulls.needs.split(), *outliers.needs.split()})), " UNION ALL ".join(parts)


query("q23_quality_profile", "s: Kind Name i: Value s: Warning", *_profile_sql())(report.quality_profile)


def _report_sql() -> tuple[str, str]:
    """The report's reference: all parts above on the clean tables."""
    clean = {f"dirty_{n}": n for n in ("payments", "shipments", "return_items", "reviews")}
    clean["dirty_orders"] = "b_orders"
    needs: set[str] = set()

    def part(name: str, value: str, blocking: int) -> str:
        sql = QUERIES[name].sql
        needs.update(clean.get(n, n) for n in QUERIES[name].needs.split())
        for dirty, table in clean.items():
            sql = sql.replace(dirty, table)
        return f"SELECT {value} AS v, {blocking} AS blocking FROM ({sql})"

    parts = [
        part("q02_null_profile", "UnexpectedNulls", 1),
        part("q01_duplicate_keys", "DuplicateValues", 1),
        part("q01_duplicate_keys", "NullKeys", 1),
        part("q24b_keys_as_they_are", "DuplicateValues", 0).replace(
            "0 AS blocking", "CAST(CheckName = 'shipments.OrderId' AS INTEGER) AS blocking"),
        part("q16_foreign_keys", "Violations", 1),
        part("q17_value_ranges", "Violations", 1),
        part("q19_check_constraints", "Violations", 0),
        part("q11_grain_reconciliation", "Violations", 1),
        part("q13_refund_bounds", "Violations", 1),
        part("q22_delivery_order", "Violations", 1),
    ]
    for name in (
        "q03_orders_without_lines", "q04_address_owner", "q05_payment_reconciliation", "q06_shipment_chronology",
        "q07_return_quantity", "q08_promotion_code", "q09_verified_review", "q10_conversion_order", "q12_order_sequence",
        "q14_conversions_match_orders",
    ):
        parts.append(part(name, "COUNT(*)", 0))
    sql = (
        "SELECT CASE WHEN COUNT(*) FILTER (v > 0 AND blocking = 1) > 0 THEN 'FAIL' ELSE 'PASS' END AS Status,"
        " COUNT(*) FILTER (v = 0) AS ChecksPassed, COUNT(*) FILTER (v > 0) AS ChecksFailed FROM ("
        + " UNION ALL ".join(parts) + ")"
    )
    return " ".join(sorted(needs)), sql


query("q21_quality_report", "s: Status i: ChecksPassed ChecksFailed", *_report_sql())(
    lambda t: report.overall(report.quality_report(t))
)
