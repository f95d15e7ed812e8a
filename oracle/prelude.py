"""Reference SQL over the driver's tables, as named pieces of one WITH clause.

Each piece lists the pieces it reads; ``with_clause`` puts them in order.
"""

from __future__ import annotations

PIECES: dict[str, tuple[tuple[str, ...], str]] = {}


def piece(name: str, needs: str, sql: str) -> None:
    PIECES[name] = (tuple(needs.split()), sql.strip())


def with_clause(names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in PIECES[name][0]:
            visit(need)
        ordered.append(name)

    for name in names.split():
        visit(name)
    if not ordered:
        return ""
    return "WITH " + ",\n".join(f"{n} AS (\n{PIECES[n][1]}\n)" for n in ordered) + "\n"


def pick(values: str, index: str) -> str:
    listed = [v.strip() for v in values.split(",")]
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(listed)) + " END"


LINE_ID = """concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER),
    CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT), CAST(l_shipdate AS DATE) - DATE '1970-01-01')"""
PRICE = "CAST(p_retailprice AS DECIMAL(12,2))"
COST = f"CAST({PRICE} * (40 + p_size) * 0.01 AS DECIMAL(12,2))"
CANCELLED = "(o_orderstatus = 'P' AND (o_orderkey // 7) % 10 < 3)"
PROMO = "CASE WHEN (o_orderkey // 16) % 6 = 0 THEN CAST(1 + (o_orderkey // 96) % 18 AS INTEGER) END"
CODE = (
    "CASE WHEN (o_orderkey // 16) % 6 = 0 THEN"
    " 'PROMO' || lpad(CAST(1 + (o_orderkey // 96) % 18 AS VARCHAR), 2, '0') END"
)

piece("segments", "", """
SELECT * FROM (VALUES (1,'AUTOMOBILE'),(2,'BUILDING'),(3,'FURNITURE'),(4,'HOUSEHOLD'),(5,'MACHINERY'))
  AS t(SegmentId, SegmentName)""")
piece("channels", "", """
SELECT * FROM (VALUES (1,'Website'),(2,'Mobile App'),(3,'Marketplace'),(4,'Social Commerce'))
  AS t(ChannelId, ChannelName)""")
piece("statuses", "", """
SELECT * FROM (VALUES (1,'Pending'),(2,'Processing'),(3,'Shipped'),(4,'Delivered'),(5,'Cancelled'))
  AS t(StatusId, StatusName)""")
piece("parent_types", "", """
SELECT * FROM (VALUES (1,'ECONOMY'),(2,'LARGE'),(3,'MEDIUM'),(4,'PROMO'),(5,'SMALL'),(6,'STANDARD'))
  AS t(TypeId, TypeName)""")
piece("categories", "parent_types", """
SELECT TypeId AS CategoryId, TypeName AS CategoryName, CAST(NULL AS INTEGER) AS ParentCategoryId FROM parent_types
UNION ALL
SELECT 6 + 4 * (TypeId - 1) + k.k + 1, TypeName || '-' || k.k, TypeId
FROM parent_types, (SELECT unnest([0,1,2,3]) AS k) k""")
piece("promotions", "", f"""
SELECT CAST(id AS INTEGER) AS PromotionId, 'PROMO' || lpad(CAST(id AS VARCHAR), 2, '0') AS PromotionCode,
       'Campaign ' || id AS PromotionName, {pick('Percentage,Fixed Amount,Free Shipping', 'id % 3')} AS PromotionType,
       CAST(5 + (id % 4) * 5 AS DECIMAL(12,2)) AS DiscountValue,
       CAST((id % 4) * 50 AS DECIMAL(12,2)) AS MinimumOrderValue,
       CAST(DATE '1995-01-01' + CAST((id - 1) * 120 AS INTEGER) AS TIMESTAMP) AS StartDate,
       CAST(DATE '1995-01-31' + CAST((id - 1) * 120 AS INTEGER) AS TIMESTAMP) AS EndDate,
       CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(1 + id % 4 AS INTEGER) END AS ChannelId
FROM range(1, 19) r(id)""")
piece("customers", "segments", f"""
SELECT c_custkey AS CustomerId, 'Customer' AS FirstName, split_part(c_name, '#', 2) AS LastName,
       lower(replace(c_name, '#', '.')) || '@example.com' AS Email,
       CAST(DATE '1994-07-01' + CAST(c_custkey % 700 AS INTEGER) AS DATE) AS AcquisitionDate,
       {pick('Organic,Paid Search,Social,Referral,Email,Marketplace', 'c_custkey % 6')} AS AcquisitionSource,
       s.SegmentId, s.SegmentName, CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS IsActive
FROM customer LEFT JOIN segments s ON s.SegmentName = c_mktsegment""")
piece("addresses", "", """
SELECT c_custkey + 1 AS AddressId, c_custkey AS CustomerId, n_name AS City, n_name AS StateProvince,
       r_name AS Region, 'US' AS CountryCode
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
piece("products", "parent_types", f"""
SELECT p_partkey AS ProductId, 'SKU' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS SKU,
       p_name || ' ' || p_partkey AS ProductName, p_brand AS BrandName,
       7 + 4 * (TypeId - 1) + p_size % 4 AS CategoryId, p_type || '-' || (p_size % 4) AS SubcategoryName,
       p_type AS CategoryName, TypeId AS ParentCategoryId, {COST} AS UnitCost, {PRICE} AS ListPrice,
       CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS LaunchDate, 1 AS IsActive
FROM part JOIN parent_types ON TypeName = p_type""")


def _orders(address: str, code: str) -> str:
    return f"""
SELECT o_orderkey AS OrderId, o_custkey AS CustomerId, {address} AS ShippingAddressId,
       CAST(o_orderkey % 4 + 1 AS INTEGER) AS ChannelId,
       CASE WHEN {CANCELLED} THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Delivered'
            WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Processing' END AS StatusName,
       {PROMO} AS PromotionId, o_orderdate AS OrderDateTime, CAST(o_orderdate AS DATE) AS OrderDate,
       {code} AS PromoCode,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 5.99 END AS DECIMAL(12,2)) AS ShippingAmount,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.05 AS DECIMAL(12,2)) AS TaxAmount
FROM orders"""


piece("b_orders", "", _orders("o_custkey + 1", CODE))
piece("dirty_orders", "", _orders(
    "CASE WHEN o_orderkey % 997 = 0 THEN (CASE WHEN o_custkey = 0 THEN 2 ELSE 1 END) ELSE o_custkey + 1 END",
    f"CASE WHEN o_orderkey % 307 = 0 THEN 'WRONG' ELSE {CODE} END"))
piece("items", "", f"""
SELECT {LINE_ID} AS OrderItemId, l_orderkey AS OrderId, l_partkey AS ProductId,
       CAST(l_quantity AS INTEGER) AS Quantity, {PRICE} AS UnitPrice, {COST} AS UnitCost,
       CAST(CAST(l_quantity AS INTEGER) * {PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS DiscountAmount
FROM lineitem JOIN part ON l_partkey = p_partkey""")


def _payments(extra: str) -> str:
    return f"""
SELECT o.OrderId * 2 + a.attempt AS PaymentId, o.OrderId, o.OrderDateTime AS PaymentDate,
       {pick('Credit Card,Debit Card,PayPal,Bank Transfer,Gift Card', 'o.OrderId % 5')} AS PaymentMethod,
       CASE WHEN a.attempt = 1 THEN 'Failed' WHEN o.StatusName = 'Cancelled' THEN 'Refunded' ELSE 'Captured' END AS PaymentStatus,
       CAST(n.Net + o.ShippingAmount + o.TaxAmount + {extra} AS DECIMAL(12,2)) AS Amount
FROM b_orders o
JOIN (SELECT OrderId, SUM(Quantity * UnitPrice - DiscountAmount) AS Net FROM items GROUP BY OrderId) n ON n.OrderId = o.OrderId
JOIN (SELECT unnest([0, 1]) AS attempt) a ON a.attempt = 0 OR o.OrderId % 40 = 0"""


piece("payments", "b_orders items", _payments("0"))
piece("dirty_payments", "b_orders items", _payments("CASE WHEN o.OrderId % 500 = 0 THEN 0.05 ELSE 0 END"))


def _shipments(delivered: str) -> str:
    return f"""
SELECT o_orderkey AS ShipmentId, o_orderkey AS OrderId, {pick('UPS,FedEx,DHL,USPS', '(o_orderkey // 4) % 4')} AS Carrier,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 3 AS INTEGER)) END AS ShippedDate,
       CAST(CAST(o_orderdate AS DATE) + CAST(4 + (o_orderkey // 3) % 4 AS INTEGER) AS DATE) AS PromisedDeliveryDate,
       CASE WHEN o_orderstatus = 'F' THEN {delivered} END AS DeliveredDate,
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit' ELSE 'Pending' END AS ShippingStatus
FROM orders WHERE NOT {CANCELLED}"""


_DELIVERED = "o_orderdate + to_days(CAST(3 + (o_orderkey // 5) % 7 AS INTEGER))"
piece("shipments", "", _shipments(_DELIVERED))
piece("dirty_shipments", "", _shipments(
    f"CASE WHEN o_orderkey % 701 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) ELSE {_DELIVERED} END"))
piece("b_returns", "", f"""
SELECT {LINE_ID} AS ReturnId, l_orderkey AS OrderId, CAST(l_shipdate AS DATE) AS ReturnDate,
       {pick('Damaged,Wrong Item,Not as Described,Changed Mind,Too Late,Defective', 'l_partkey % 6')} AS ReturnReason,
       CASE WHEN l_suppkey % 20 = 0 THEN 'Rejected' ELSE {pick('Requested,Approved,Received,Refunded', 'l_suppkey % 4')} END AS ReturnStatus
FROM lineitem WHERE l_returnflag = 'R'""")


def _return_items(quantity: str) -> str:
    return f"""
SELECT {LINE_ID} AS ReturnItemId, {LINE_ID} AS ReturnId, {LINE_ID} AS OrderItemId, {quantity} AS ReturnQuantity,
       {PRICE} - CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS RefundAmount
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'"""


piece("return_items", "", _return_items("1"))
piece("dirty_return_items", "", _return_items("CASE WHEN l_orderkey % 211 = 0 THEN CAST(l_quantity AS INTEGER) + 1 ELSE 1 END"))


def _reviews(customer: str) -> str:
    return f"""
SELECT {LINE_ID} AS ReviewId, {customer} AS CustomerId, l_partkey AS ProductId, {LINE_ID} AS OrderItemId,
       o_orderdate + to_days(15) AS ReviewDate, CAST(1 + (l_partkey + l_suppkey) % 5 AS INTEGER) AS Rating,
       'Rated ' || (1 + (l_partkey + l_suppkey) % 5) AS ReviewTitle, CAST(NULL AS VARCHAR) AS ReviewText,
       CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS IsVerifiedPurchase, CAST(l_suppkey % 7 AS INTEGER) AS HelpfulVotes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F'"""


piece("reviews", "", _reviews("o_custkey"))
piece("dirty_reviews", "", _reviews("CASE WHEN l_orderkey % 401 = 0 THEN o_custkey + 1 ELSE o_custkey END"))
piece("interactions", "", f"""
SELECT event_id AS InteractionId, 1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 18 AS PromotionId,
       user_id AS CustomerId, ts AS InteractionDate,
       CASE event_type WHEN 'view' THEN 'Impression' WHEN 'signup' THEN 'Sent' WHEN 'click' THEN 'Click'
            WHEN 'purchase' THEN 'Conversion' ELSE 'Unsubscribe' END AS InteractionType,
       {pick('Email,Paid Social,Display,Push,SMS', 'event_id % 5')} AS ChannelName,
       CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN event_id // 8 * 12 END AS OrderId
FROM events""")
piece("calendar", "b_orders", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, CAST(d AS DATE) AS FullDate, year(d) AS CalendarYear,
       quarter(d) AS CalendarQuarter, month(d) AS MonthNumber, strftime(d, '%B') AS MonthName,
       strftime(d, '%Y-%m') AS YearMonth, weekofyear(d) AS WeekOfYear, day(d) AS DayOfMonth,
       strftime(d, '%A') AS DayName, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS IsWeekend
FROM (SELECT unnest(generate_series(CAST(MIN(OrderDate) AS TIMESTAMP), CAST(MAX(OrderDate) AS TIMESTAMP) + to_days(365), INTERVAL 1 DAY)) AS d
      FROM b_orders)""")

# ---------------------------------------------------------------- facts
# ``live`` is 1 for orders that count and 0 for cancelled ones.
piece("refunds", "b_returns return_items", """
SELECT OrderItemId, SUM(ReturnQuantity) AS ReturnedQuantity, SUM(return_items.RefundAmount) AS RefundAmount
FROM return_items JOIN b_returns USING (ReturnId) WHERE ReturnStatus != 'Rejected' GROUP BY OrderItemId""")
piece("headers", "b_orders channels promotions", """
SELECT b_orders.* EXCLUDE (ShippingAddressId), ShippingAddressId AS AddressId, ChannelName, PromotionName,
       year(OrderDate) * 10000 + month(OrderDate) * 100 + day(OrderDate) AS OrderDateKey,
       CAST(date_trunc('month', OrderDate) AS DATE) AS MonthStart, CAST(StatusName != 'Cancelled' AS INTEGER) AS live
FROM b_orders JOIN channels USING (ChannelId) LEFT JOIN promotions USING (PromotionId)""")
piece("line_values", "items headers refunds", """
SELECT items.*, h.* EXCLUDE (OrderId), Quantity * UnitPrice AS GrossRevenue,
       live * (Quantity * UnitPrice - DiscountAmount) AS NetRevenue, live * Quantity * UnitCost AS COGS,
       COALESCE(refunds.ReturnedQuantity, 0) AS ReturnedQuantity, COALESCE(refunds.RefundAmount, 0) AS RefundAmount
FROM items JOIN headers h USING (OrderId) LEFT JOIN refunds USING (OrderItemId)""")
piece("order_lines", "line_values customers addresses products", """
SELECT v.*, concat(FirstName, ' ', LastName) AS CustomerName, AcquisitionSource, SegmentName, City, StateProvince, Region, CountryCode,
       SKU, ProductName, BrandName, SubcategoryName, CategoryName, NetRevenue - COGS AS GrossProfit,
       NetRevenue - live * RefundAmount AS RevenueAfterRefund, NetRevenue - COGS - live * RefundAmount AS GrossProfitAfterRefund,
       CAST(DiscountAmount AS DOUBLE) / NULLIF(CAST(GrossRevenue AS DOUBLE), 0) AS DiscountRate, live AS IsValidOrder
FROM line_values v JOIN customers USING (CustomerId) JOIN (SELECT * EXCLUDE (CustomerId) FROM addresses) USING (AddressId)
JOIN (SELECT ProductId, SKU, ProductName, BrandName, SubcategoryName, CategoryName FROM products) USING (ProductId)""")
piece("numbered", "headers", """
SELECT OrderId, SUM(live) OVER (PARTITION BY CustomerId ORDER BY OrderDateTime, OrderId ROWS UNBOUNDED PRECEDING) AS CustomerOrderNumber
FROM headers""")
piece("order_summary", "line_values numbered headers customers addresses shipments", """
SELECT h.*, CAST(CustomerOrderNumber AS BIGINT) AS CustomerOrderNumber, live * CAST(CustomerOrderNumber > 1 AS INTEGER) AS IsRepeatPurchase,
       SegmentName, AcquisitionSource, City, StateProvince, Region, CountryCode,
       Units, GrossRevenue, DiscountAmount, NetRevenue, NetRevenue - live * RefundAmount AS RevenueAfterRefund,
       NetRevenue - COGS AS GrossProfit, NetRevenue - COGS - live * RefundAmount AS GrossProfitAfterRefund,
       ReturnedUnits, RefundAmount, Carrier, CAST(ShippedDate AS DATE) AS ShippedDate, PromisedDeliveryDate,
       CAST(DeliveredDate AS DATE) AS DeliveredDate, CAST(DeliveredDate AS DATE) - OrderDate AS DeliveryDays,
       CAST(CAST(DeliveredDate AS DATE) <= PromisedDeliveryDate AS INTEGER) AS IsOnTime
FROM headers h JOIN numbered USING (OrderId)
JOIN (SELECT OrderId, SUM(Quantity) AS Units, SUM(GrossRevenue) AS GrossRevenue, SUM(DiscountAmount) AS DiscountAmount,
             SUM(NetRevenue) AS NetRevenue, SUM(COGS) AS COGS, SUM(ReturnedQuantity) AS ReturnedUnits, SUM(RefundAmount) AS RefundAmount
      FROM line_values GROUP BY OrderId) USING (OrderId)
JOIN (SELECT CustomerId, SegmentName, AcquisitionSource FROM customers) USING (CustomerId)
JOIN (SELECT * EXCLUDE (CustomerId) FROM addresses) USING (AddressId)
LEFT JOIN (SELECT * EXCLUDE (ShipmentId) FROM shipments) USING (OrderId)""")
piece("valid_orders", "order_summary", "SELECT * FROM order_summary WHERE live = 1")
piece("as_of", "b_orders", "SELECT CAST(MAX(OrderDate) + 1 AS DATE) AS AsOfDate FROM b_orders")
piece("order_gaps", "valid_orders", """
SELECT CustomerId, OrderDate - LAG(OrderDate) OVER (PARTITION BY CustomerId ORDER BY OrderDateTime, OrderId) AS Gap FROM valid_orders""")
piece("customer_metrics", "customers valid_orders order_gaps as_of", """
WITH lifetime AS (
  SELECT CustomerId, MIN(OrderDate) AS FirstOrderDate, MAX(OrderDate) AS LastOrderDate, COUNT(*) AS n, SUM(NetRevenue) AS net,
         SUM(RevenueAfterRefund) AS kept, SUM(GrossProfit) AS profit, SUM(ReturnedUnits) AS units FROM valid_orders GROUP BY CustomerId),
cadence AS (SELECT CustomerId, CAST(SUM(Gap) AS DOUBLE) / COUNT(Gap) AS gap FROM order_gaps GROUP BY CustomerId),
base AS (
  SELECT *, AsOfDate - LastOrderDate AS quiet, COALESCE(gap, 45) AS pace,
         CAST(greatest(AsOfDate - AcquisitionDate, 90) AS DOUBLE) / 365.25 AS years
  FROM customers LEFT JOIN lifetime USING (CustomerId) LEFT JOIN cadence USING (CustomerId), as_of)
SELECT CustomerId, concat(FirstName, ' ', LastName) AS CustomerName, Email, AcquisitionDate, AcquisitionSource, SegmentName, IsActive,
       AsOfDate, FirstOrderDate, LastOrderDate, COALESCE(n, 0) AS LifetimeOrders, COALESCE(net, 0) AS LifetimeRevenue,
       COALESCE(kept, 0) AS LifetimeRevenueAfterRefund, COALESCE(profit, 0) AS LifetimeGrossProfit,
       COALESCE(CAST(net AS DOUBLE) / n, 0) AS AverageOrderValue, gap AS AvgDaysBetweenOrders, quiet AS RecencyDays,
       COALESCE(units, 0) AS ReturnedUnits, CAST(COALESCE(n, 0) > 1 AS INTEGER) AS IsRepeatCustomer,
       CAST(floor(CAST(COALESCE(kept, 0) AS DOUBLE) / years * 100.0 + 0.5) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS Projected12MonthRevenue,
       CASE WHEN n IS NULL THEN 'Prospect'
            WHEN n = 1 THEN (CASE WHEN quiet > 90 THEN 'One-Time Lapsed' ELSE 'Active' END)
            WHEN quiet > 90 AND quiet > 2 * pace THEN 'High Risk'
            WHEN quiet > 60 AND quiet > 1.5 * pace THEN 'At Risk' ELSE 'Active' END AS LifecycleStatus
FROM base""")
piece("month_spine", "b_orders calendar", """
SELECT DateKey, FullDate AS MonthStart, CalendarYear, CalendarQuarter, MonthNumber, MonthName, YearMonth FROM calendar
WHERE DayOfMonth = 1 AND FullDate >= (SELECT date_trunc('month', MIN(OrderDate)) FROM b_orders)
  AND FullDate <= (SELECT MAX(OrderDate) FROM b_orders)""")
piece("monthly_kpis", "month_spine valid_orders", """
SELECT s.*, COALESCE(Orders, 0) AS Orders, COALESCE(ActiveCustomers, 0) AS ActiveCustomers, COALESCE(RepeatOrders, 0) AS RepeatOrders,
       COALESCE(NetRevenue, 0) AS NetRevenue, COALESCE(RevenueAfterRefund, 0) AS RevenueAfterRefund,
       COALESCE(GrossProfit, 0) AS GrossProfit, COALESCE(CAST(NetRevenue AS DOUBLE) / Orders, 0) AS AverageOrderValue,
       COALESCE(Discounts, 0) AS Discounts, COALESCE(ReturnedUnits, 0) AS ReturnedUnits
FROM month_spine s LEFT JOIN (
  SELECT MonthStart, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS ActiveCustomers, SUM(IsRepeatPurchase) AS RepeatOrders,
         SUM(NetRevenue) AS NetRevenue, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfit) AS GrossProfit,
         SUM(DiscountAmount) AS Discounts, SUM(ReturnedUnits) AS ReturnedUnits
  FROM valid_orders GROUP BY MonthStart) USING (MonthStart)""")
piece("monthly_performance", "monthly_kpis", """
WITH shifted AS (
  SELECT m.*, p.NetRevenue AS PreviousMonthRevenue, y.NetRevenue AS PreviousYearRevenue, p.GrossProfit AS PreviousMonthGrossProfit,
         (SELECT CAST(SUM(r.NetRevenue) AS DOUBLE) / COUNT(*) FROM monthly_kpis r
          WHERE r.MonthStart <= m.MonthStart AND r.MonthStart > m.MonthStart - INTERVAL 3 MONTH) AS Rolling3MonthRevenue,
         (SELECT CAST(SUM(r.NetRevenue) AS DOUBLE) / COUNT(*) FROM monthly_kpis r
          WHERE r.MonthStart <= m.MonthStart AND r.MonthStart > m.MonthStart - INTERVAL 12 MONTH) AS Rolling12MonthRevenue,
         (SELECT SUM(r.NetRevenue) FROM monthly_kpis r WHERE r.MonthStart <= m.MonthStart) AS RunningRevenue
  FROM monthly_kpis m LEFT JOIN monthly_kpis p ON p.MonthStart = m.MonthStart - INTERVAL 1 MONTH
  LEFT JOIN monthly_kpis y ON y.MonthStart = m.MonthStart - INTERVAL 12 MONTH)
SELECT *, (CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(PreviousMonthRevenue AS DOUBLE), 0) - 1.0) * 100.0 AS RevenueMoMPct,
       (CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(PreviousYearRevenue AS DOUBLE), 0) - 1.0) * 100.0 AS RevenueYoYPct,
       (CAST(GrossProfit AS DOUBLE) / NULLIF(CAST(PreviousMonthGrossProfit AS DOUBLE), 0) - 1.0) * 100.0 AS GrossProfitMoMPct
FROM shifted""")
piece("cohort_retention", "valid_orders", """
WITH joined AS (SELECT CustomerId, MIN(MonthStart) AS CohortMonth FROM valid_orders GROUP BY CustomerId),
sizes AS (SELECT CohortMonth, COUNT(*) AS CohortSize FROM joined GROUP BY CohortMonth)
SELECT CohortMonth, date_diff('month', CohortMonth, MonthStart) AS MonthsSinceFirstOrder, COUNT(DISTINCT CustomerId) AS ActiveCustomers,
       CohortSize, CAST(COUNT(DISTINCT CustomerId) AS DOUBLE) / CohortSize AS RetentionRate
FROM valid_orders JOIN joined USING (CustomerId) JOIN sizes USING (CohortMonth) GROUP BY CohortMonth, MonthStart, CohortSize""")
piece("product_performance", "order_lines reviews", """
WITH sold AS (
  SELECT ProductId, any_value(SKU) AS SKU, any_value(ProductName) AS ProductName, any_value(BrandName) AS BrandName,
         any_value(SubcategoryName) AS SubcategoryName, any_value(CategoryName) AS CategoryName, COUNT(DISTINCT OrderId) AS Orders,
         SUM(Quantity) AS UnitsSold, SUM(GrossRevenue) AS GrossRevenue, SUM(DiscountAmount) AS DiscountAmount,
         SUM(NetRevenue) AS NetRevenue, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfit) AS GrossProfit,
         SUM(ReturnedQuantity) AS ReturnedUnits, SUM(RefundAmount) AS RefundAmount
  FROM order_lines WHERE live = 1 GROUP BY ProductId),
rated AS (SELECT ProductId, COUNT(*) AS n, SUM(Rating) AS stars FROM reviews GROUP BY ProductId)
SELECT sold.*, COALESCE(n, 0) AS Reviews, CAST(stars AS DOUBLE) / n AS AverageRating,
       CAST(GrossProfit AS DOUBLE) / NULLIF(CAST(NetRevenue AS DOUBLE), 0) AS GrossMarginRate,
       CAST(ReturnedUnits AS DOUBLE) / NULLIF(CAST(UnitsSold AS DOUBLE), 0) AS UnitReturnRate,
       CAST(DiscountAmount AS DOUBLE) / NULLIF(CAST(GrossRevenue AS DOUBLE), 0) AS DiscountRate
FROM sold LEFT JOIN rated USING (ProductId)""")
piece("campaign_performance", "promotions interactions valid_orders", """
WITH reach AS (SELECT PromotionId, COUNT(DISTINCT CustomerId) AS Audience FROM interactions
               WHERE InteractionType IN ('Impression', 'Sent') GROUP BY PromotionId),
acts AS (SELECT PromotionId, COUNT(*) FILTER (InteractionType = 'Click') AS Clicks,
                COUNT(*) FILTER (InteractionType = 'Conversion') AS Conversions FROM interactions GROUP BY PromotionId),
paid AS (SELECT PromotionId, COUNT(*) AS n, SUM(NetRevenue) AS net, SUM(RevenueAfterRefund) AS kept, SUM(GrossProfit) AS profit,
                SUM(DiscountAmount) AS cost FROM valid_orders GROUP BY PromotionId)
SELECT promotions.*, COALESCE(Audience, 0) AS Audience, COALESCE(Clicks, 0) AS Clicks, COALESCE(Conversions, 0) AS Conversions,
       CAST(Clicks AS DOUBLE) / Audience AS ClickThroughRate, CAST(Conversions AS DOUBLE) / NULLIF(Clicks, 0) AS ClickToConversionRate,
       COALESCE(n, 0) AS AttributedOrders, COALESCE(net, 0) AS AttributedRevenue, COALESCE(kept, 0) AS AttributedRevenueAfterRefund,
       COALESCE(profit, 0) AS AttributedGrossProfit, COALESCE(cost, 0) AS DiscountCost
FROM promotions LEFT JOIN reach USING (PromotionId) LEFT JOIN acts USING (PromotionId) LEFT JOIN paid USING (PromotionId)""")
# Score ranges of each segment, first match by priority.
piece("rfm_rules", "", """
SELECT * FROM (VALUES (1,'Champions',4,5,4,5,4,5),(2,'Loyal Customers',3,5,4,5,1,5),(3,'New Customers',5,5,1,2,1,5),
  (4,'Potential Loyalists',4,5,2,3,1,5),(5,'At Risk',1,2,3,5,1,5),(6,'Hibernating',1,2,1,2,1,5),(7,'Needs Attention',1,5,1,5,1,5))
  AS t(priority, Segment, r1, r2, f1, f2, m1, m2)""")
piece("rfm_base", "valid_orders as_of", """
SELECT CustomerId, AsOfDate AS SnapshotDate, AsOfDate - MAX(OrderDate) AS RecencyDays, COUNT(*) AS Frequency,
       SUM(RevenueAfterRefund) AS MonetaryValue
FROM valid_orders, as_of WHERE OrderDate <= AsOfDate GROUP BY CustomerId, AsOfDate""")
piece("rfm", "rfm_base rfm_rules", """
WITH scored AS (
  SELECT *, 6 - ntile(5) OVER (ORDER BY RecencyDays, CustomerId) AS RScore, ntile(5) OVER (ORDER BY Frequency, CustomerId) AS FScore,
         ntile(5) OVER (ORDER BY MonetaryValue, CustomerId) AS MScore FROM rfm_base)
SELECT scored.*, concat(RScore, FScore, MScore) AS RfmCode, arg_min(Segment, priority) AS Segment
FROM scored JOIN rfm_rules ON RScore BETWEEN r1 AND r2 AND FScore BETWEEN f1 AND f2 AND MScore BETWEEN m1 AND m2 GROUP BY ALL""")
