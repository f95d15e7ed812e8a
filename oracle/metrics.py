"""Metric relations m01 to m41 and the operator checks beside them."""

from __future__ import annotations

from oracle.catalog import query
from oracle.prelude import piece
from orderwell.functions.ordered import Ordering, order_globally
from orderwell.operators import (
    basket,
    concentration,
    customers,
    facts,
    insights,
    marketing,
    operations,
    products,
    sales,
)

START, END = "1996-01-01", "1999-12-31"

query(
    "m01_order_lines",
    "s: OrderItemId i: OrderId t: OrderDateTime d: OrderDate i: OrderDateKey CustomerId s: CustomerName AcquisitionSource"
    " SegmentName ChannelName StatusName City StateProvince Region CountryCode i: ProductId s: SKU ProductName BrandName"
    " SubcategoryName CategoryName i: Quantity f: UnitPrice UnitCost DiscountAmount GrossRevenue NetRevenue COGS GrossProfit"
    " i: ReturnedQuantity f: RefundAmount RevenueAfterRefund GrossProfitAfterRefund DiscountRate i: PromotionId s: PromoCode PromotionName",
    "order_lines", "SELECT * FROM order_lines",
)(facts.order_lines)
query(
    "m02_order_summary",
    "i: OrderId t: OrderDateTime d: OrderDate i: OrderDateKey CustomerId CustomerOrderNumber IsRepeatPurchase s: SegmentName ChannelName"
    " StatusName City StateProvince Region CountryCode i: Units f: GrossRevenue DiscountAmount NetRevenue RevenueAfterRefund GrossProfit"
    " GrossProfitAfterRefund ShippingAmount TaxAmount i: PromotionId s: PromoCode PromotionName i: ReturnedUnits f: RefundAmount"
    " s: Carrier d: ShippedDate PromisedDeliveryDate DeliveredDate i: DeliveryDays IsOnTime",
    "order_summary", "SELECT * FROM order_summary",
)(facts.order_summary)
query(
    "m03_customer_metrics",
    "i: CustomerId s: CustomerName Email d: AcquisitionDate s: AcquisitionSource SegmentName i: IsActive d: AsOfDate FirstOrderDate"
    " LastOrderDate i: LifetimeOrders f: LifetimeRevenue LifetimeRevenueAfterRefund LifetimeGrossProfit AverageOrderValue"
    " AvgDaysBetweenOrders i: RecencyDays ReturnedUnits IsRepeatCustomer f: Projected12MonthRevenue s: LifecycleStatus",
    "customer_metrics", "SELECT * FROM customer_metrics",
)(customers.customer_metrics)
_MONTH = (
    "i: DateKey d: MonthStart i: CalendarYear CalendarQuarter MonthNumber s: MonthName YearMonth i: Orders ActiveCustomers RepeatOrders"
    " f: NetRevenue RevenueAfterRefund GrossProfit AverageOrderValue Discounts i: ReturnedUnits"
)
query("m04_monthly_kpis", _MONTH, "monthly_kpis", "SELECT * FROM monthly_kpis")(sales.monthly_kpis)
query(
    "m05_monthly_performance",
    _MONTH + " f: PreviousMonthRevenue PreviousYearRevenue PreviousMonthGrossProfit Rolling3MonthRevenue Rolling12MonthRevenue"
    " RunningRevenue RevenueMoMPct RevenueYoYPct GrossProfitMoMPct",
    "monthly_performance", "SELECT * FROM monthly_performance",
)(sales.monthly_performance)
query(
    "m05b_monthly_fractions",
    "d: MonthStart f: NetRevenue RevenueMoMPct RevenueYoYPct Rolling3MonthRevenue Rolling12MonthRevenue RunningRevenue GrossMarginRate RepeatOrderRate",
    "monthly_performance", """
SELECT * REPLACE (CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(PreviousMonthRevenue AS DOUBLE), 0) - 1 AS RevenueMoMPct,
                  CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(PreviousYearRevenue AS DOUBLE), 0) - 1 AS RevenueYoYPct),
       CAST(GrossProfit AS DOUBLE) / NULLIF(CAST(NetRevenue AS DOUBLE), 0) AS GrossMarginRate,
       CAST(RepeatOrders AS DOUBLE) / NULLIF(CAST(Orders AS DOUBLE), 0) AS RepeatOrderRate
FROM monthly_performance""",
)(sales.monthly_performance_fractions)
_COHORT = "d: CohortMonth i: MonthsSinceFirstOrder ActiveCustomers CohortSize f: RetentionRate"
query("m06_cohort_retention", _COHORT, "cohort_retention", "SELECT * FROM cohort_retention")(
    customers.cohort_retention
)
query(
    "m07_product_performance",
    "i: ProductId s: SKU ProductName BrandName SubcategoryName CategoryName i: Orders UnitsSold f: GrossRevenue DiscountAmount NetRevenue"
    " RevenueAfterRefund GrossProfit i: ReturnedUnits f: RefundAmount i: Reviews f: AverageRating GrossMarginRate UnitReturnRate DiscountRate",
    "product_performance", "SELECT * FROM product_performance",
)(products.product_performance)
query(
    "m08_return_analysis",
    "s: ReturnId i: OrderId d: ReturnDate s: ReturnReason ReturnStatus OrderItemId i: ProductId s: ProductName BrandName SubcategoryName"
    " CategoryName i: ReturnQuantity f: RefundAmount i: PurchasedQuantity f: LineReturnRate",
    "b_returns return_items items products", """
SELECT b_returns.*, OrderItemId, products.*, ReturnQuantity, RefundAmount, Quantity AS PurchasedQuantity,
       CAST(ReturnQuantity AS DOUBLE) / NULLIF(Quantity, 0) AS LineReturnRate
FROM return_items JOIN b_returns USING (ReturnId) JOIN (SELECT OrderItemId, ProductId, Quantity FROM items) USING (OrderItemId)
JOIN products USING (ProductId)""",
)(operations.return_analysis)
query(
    "m08b_return_facts",
    "s: ReturnItemId ReturnId OrderItemId i: OrderId ReturnDateKey d: ReturnDate i: OrderDateKey CustomerId ProductId ChannelId PromotionId"
    " s: ReturnReason ReturnStatus i: ReturnQuantity f: RefundAmount LineReturnRate",
    "b_returns return_items items headers", """
SELECT ri.*, r.* EXCLUDE (ReturnId, OrderId), year(ReturnDate) * 10000 + month(ReturnDate) * 100 + day(ReturnDate) AS ReturnDateKey,
       h.OrderId, OrderDateKey, CustomerId, ProductId, ChannelId, PromotionId, CAST(ReturnQuantity AS DOUBLE) / Quantity AS LineReturnRate
FROM return_items ri JOIN b_returns r USING (ReturnId) JOIN items i ON i.OrderItemId = ri.OrderItemId AND i.OrderId = r.OrderId
JOIN headers h ON h.OrderId = r.OrderId""",
)(operations.return_facts)
query(
    "m09_review_analytics",
    "s: ReviewId t: ReviewDate i: CustomerId s: SegmentName i: ProductId s: SKU ProductName BrandName SubcategoryName CategoryName i: Rating"
    " s: ReviewTitle i: IsVerifiedPurchase HelpfulVotes WasReturned",
    "reviews customers products return_items", """
SELECT r.*, SegmentName, SKU, ProductName, BrandName, SubcategoryName, CategoryName,
       CAST(OrderItemId IN (SELECT OrderItemId FROM return_items) AS INTEGER) AS WasReturned
FROM reviews r JOIN customers USING (CustomerId) JOIN products USING (ProductId)""",
)(operations.review_analytics)
query(
    "m10_campaign_performance",
    "i: PromotionId s: PromotionCode PromotionName PromotionType t: StartDate EndDate i: Audience Clicks Conversions f: ClickThroughRate"
    " ClickToConversionRate i: AttributedOrders f: AttributedRevenue AttributedRevenueAfterRefund AttributedGrossProfit DiscountCost",
    "campaign_performance", "SELECT * FROM campaign_performance",
)(marketing.campaign_performance)

_SALES = (
    "d: MonthStart i: Orders ActiveCustomers RepeatOrders f: NetRevenue RevenueAfterRefund GrossProfit AverageOrderValue RevenueMoMPct"
    " RevenueYoYPct Rolling3MonthRevenue RunningRevenue"
)


def _sales_sql(condition: str) -> str:
    return f"""
WITH m AS (
  SELECT MonthStart, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS ActiveCustomers, SUM(IsRepeatPurchase) AS RepeatOrders,
         SUM(NetRevenue) AS NetRevenue, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfit) AS GrossProfit,
         CAST(SUM(NetRevenue) AS DOUBLE) / COUNT(*) AS AverageOrderValue
  FROM valid_orders WHERE OrderDate BETWEEN DATE '{START}' AND DATE '{END}' AND {condition} GROUP BY MonthStart)
SELECT *, (CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(LAG(NetRevenue) OVER w AS DOUBLE), 0) - 1.0) * 100.0 AS RevenueMoMPct,
       (CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(LAG(NetRevenue, 12) OVER w AS DOUBLE), 0) - 1.0) * 100.0 AS RevenueYoYPct,
       CAST(SUM(NetRevenue) OVER r AS DOUBLE) / COUNT(*) OVER r AS Rolling3MonthRevenue,
       SUM(NetRevenue) OVER (ORDER BY MonthStart ROWS UNBOUNDED PRECEDING) AS RunningRevenue
FROM m WINDOW w AS (ORDER BY MonthStart), r AS (ORDER BY MonthStart ROWS 2 PRECEDING)"""


query("m11_sales_performance", _SALES, "valid_orders", _sales_sql("true"))(
    lambda t: sales.sales_performance(t, START, END)
)
query(
    "m11b_sales_channel_region", _SALES, "valid_orders",
    _sales_sql("ChannelName = 'Website' AND Region = 'ASIA'"),
)(lambda t: sales.sales_performance(t, START, END, channel="Website", region="ASIA"))

query(
    "m12a_customer_profile",
    "i: CustomerId s: CustomerName d: AcquisitionDate s: AcquisitionSource SegmentName d: FirstOrderDate LastOrderDate i: LifetimeOrders"
    " f: LifetimeRevenue LifetimeRevenueAfterRefund LifetimeGrossProfit AverageOrderValue AvgDaysBetweenOrders i: RecencyDays"
    " f: Projected12MonthRevenue s: LifecycleStatus",
    "customer_metrics", "SELECT * FROM customer_metrics WHERE CustomerId = 77",
)(lambda t: customers.customer_360(t, 77)["profile"])
query(
    "m12b_customer_orders",
    "i: OrderId t: OrderDateTime i: CustomerOrderNumber IsRepeatPurchase s: ChannelName StatusName f: NetRevenue RevenueAfterRefund"
    " GrossProfit RefundAmount i: DeliveryDays IsOnTime",
    "order_summary", "SELECT * FROM order_summary WHERE CustomerId = 77",
)(lambda t: customers.customer_360(t, 77)["orders"])
query(
    "m12c_customer_products", "i: ProductId s: ProductName CategoryName i: Units f: NetRevenue i: PreferenceRank",
    "order_lines", """
SELECT ProductId, any_value(ProductName) AS ProductName, any_value(CategoryName) AS CategoryName, SUM(Quantity) AS Units,
       SUM(NetRevenue) AS NetRevenue, row_number() OVER (ORDER BY SUM(NetRevenue) DESC, ProductId) AS PreferenceRank
FROM order_lines WHERE CustomerId = 77 AND live = 1 GROUP BY ProductId QUALIFY PreferenceRank <= 5""",
)(lambda t: customers.customer_360(t, 77)["products"])

_RFM = "d: SnapshotDate i: CustomerId RecencyDays Frequency f: MonetaryValue i: RScore FScore MScore s: RfmCode Segment"
query("m13a_rfm_snapshot", _RFM, "rfm", "SELECT * FROM rfm")(customers.rfm_snapshot)
_SEGMENTS = "s: Segment i: Customers f: AvgRecencyDays AvgFrequency SegmentValue"
_SEGMENT_SQL = """
SELECT Segment, COUNT(*) AS Customers, CAST(SUM(RecencyDays) AS DOUBLE) / COUNT(*) AS AvgRecencyDays,
       CAST(SUM(Frequency) AS DOUBLE) / COUNT(*) AS AvgFrequency, SUM(MonetaryValue) AS SegmentValue FROM rfm GROUP BY Segment"""
query("m13b_rfm_summary", _SEGMENTS, "rfm", _SEGMENT_SQL)(
    lambda t: customers.rfm_summary(customers.rfm_snapshot(t))
)
query(
    "m13c_rfm_as_of", "i: CustomerId RecencyDays Frequency f: MonetaryValue", "valid_orders", """
SELECT CustomerId, DATE '1998-06-30' - MAX(OrderDate) AS RecencyDays, COUNT(*) AS Frequency, SUM(RevenueAfterRefund) AS MonetaryValue
FROM valid_orders WHERE OrderDate <= DATE '1998-06-30' GROUP BY CustomerId""",
)(lambda t: customers.rfm_snapshot(t, "1998-06-30"))
query(
    "w15_percentile_score", "i: CustomerId RScore FScore MScore", "rfm_base", """
SELECT CustomerId, 6 - CAST(ceil(row_number() OVER (ORDER BY RecencyDays, CustomerId) * 5.0 / COUNT(*) OVER ()) AS INTEGER) AS RScore,
       CAST(ceil(row_number() OVER (ORDER BY Frequency, CustomerId) * 5.0 / COUNT(*) OVER ()) AS INTEGER) AS FScore,
       CAST(ceil(row_number() OVER (ORDER BY MonetaryValue, CustomerId) * 5.0 / COUNT(*) OVER ()) AS INTEGER) AS MScore FROM rfm_base""",
)(lambda t: customers.rfm_snapshot(t, method="percentile"))
query(
    "m14_product_affinity",
    "i: ProductAId s: ProductA i: ProductBId s: ProductB i: PairOrders f: Support ConfidenceAToB ConfidenceBToA Lift i: LiftRank",
    "line_values products", """
WITH b AS (SELECT DISTINCT OrderId, ProductId FROM line_values WHERE live = 1 AND OrderDate BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'),
n AS (SELECT CAST(COUNT(DISTINCT OrderId) AS DOUBLE) AS n FROM b),
s AS (SELECT ProductId, CAST(COUNT(*) AS DOUBLE) AS orders FROM b GROUP BY ProductId),
p AS (SELECT x.ProductId AS A, y.ProductId AS B, COUNT(*) AS PairOrders FROM b x JOIN b y ON x.OrderId = y.OrderId AND x.ProductId < y.ProductId
      GROUP BY A, B HAVING COUNT(*) >= 2),
scored AS (SELECT A, B, PairOrders, PairOrders / n AS Support, PairOrders / sa.orders AS ab, PairOrders / sb.orders AS ba,
                  (CAST(PairOrders AS DOUBLE) * n) / (sa.orders * sb.orders) AS Lift
           FROM p JOIN s sa ON sa.ProductId = A JOIN s sb ON sb.ProductId = B, n)
SELECT A AS ProductAId, pa.ProductName AS ProductA, B AS ProductBId, pb.ProductName AS ProductB, PairOrders, Support,
       ab AS ConfidenceAToB, ba AS ConfidenceBToA, Lift, dense_rank() OVER (ORDER BY Lift DESC) AS LiftRank
FROM scored JOIN products pa ON pa.ProductId = A JOIN products pb ON pb.ProductId = B
ORDER BY Lift DESC, PairOrders DESC, A, B LIMIT 50""",
)(lambda t: basket.product_affinity(t, "1995-01-01", "2001-12-31", min_pair_orders=2, top_n=50))
query(
    "m15_cohort_range", _COHORT + " PreviousMonthRetention RetentionPointChange", "cohort_retention", """
SELECT *, LAG(RetentionRate) OVER w AS PreviousMonthRetention, RetentionRate - LAG(RetentionRate) OVER w AS RetentionPointChange
FROM cohort_retention WHERE CohortMonth BETWEEN DATE '1995-01-01' AND DATE '1996-06-01' AND MonthsSinceFirstOrder <= 24
WINDOW w AS (PARTITION BY CohortMonth ORDER BY MonthsSinceFirstOrder)""",
)(lambda t: customers.cohort_retention_range(t, "1995-01-15", "1996-06-20", 24))
query(
    "m16_product_ranking",
    "i: ProductId s: ProductName CategoryName i: Orders UnitsSold f: NetRevenue GrossProfit i: RevenueRankInCategory ProfitRankInCategory"
    " OverallRevenueRowNumber",
    "product_performance", """
SELECT *, dense_rank() OVER (PARTITION BY CategoryName ORDER BY NetRevenue DESC) AS RevenueRankInCategory,
       dense_rank() OVER (PARTITION BY CategoryName ORDER BY GrossProfit DESC) AS ProfitRankInCategory,
       row_number() OVER (ORDER BY NetRevenue DESC, ProductId) AS OverallRevenueRowNumber
FROM product_performance WHERE Orders >= 20 ORDER BY NetRevenue DESC, ProductId LIMIT 100""",
)(lambda t: products.product_ranking(t, min_orders=20, top_n=100))
query(
    "m16b_product_ranking_category",
    "i: ProductId s: CategoryName f: NetRevenue i: RevenueRankInCategory ProfitRankInCategory OverallRevenueRowNumber",
    "product_performance", """
SELECT *, dense_rank() OVER (ORDER BY NetRevenue DESC) AS RevenueRankInCategory, dense_rank() OVER (ORDER BY GrossProfit DESC) AS ProfitRankInCategory,
       row_number() OVER (ORDER BY NetRevenue DESC, ProductId) AS OverallRevenueRowNumber
FROM product_performance WHERE Orders >= 20 AND CategoryName = 'PROMO' ORDER BY NetRevenue DESC, ProductId LIMIT 25""",
)(lambda t: products.product_ranking(t, category="PROMO", min_orders=20))
query(
    "m18_executive_trend",
    "d: MonthStart i: Orders ActiveCustomers f: NetRevenue RevenueAfterRefund GrossProfit AverageOrderValue RevenueMoMPct RevenueYoYPct"
    " Rolling3MonthRevenue Rolling12MonthRevenue RunningRevenue",
    "monthly_performance", f"SELECT * FROM monthly_performance WHERE MonthStart BETWEEN DATE '{START}' AND DATE '{END}'",
)(lambda t: sales.executive_trend(t, START, END))
query(
    "m19_annual_growth",
    "i: CalendarYear Orders ActiveCustomers f: NetRevenue GrossProfit AverageOrderValue RevenueYoYPct OrdersYoYPct CustomersYoYPct AOVYoYPct",
    "valid_orders", f"""
WITH y AS (SELECT year(OrderDate) AS CalendarYear, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS ActiveCustomers, SUM(NetRevenue) AS NetRevenue,
                  SUM(GrossProfit) AS GrossProfit, CAST(SUM(NetRevenue) AS DOUBLE) / COUNT(*) AS AverageOrderValue
           FROM valid_orders WHERE OrderDate BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1)
SELECT a.*, (CAST(a.NetRevenue AS DOUBLE) / CAST(b.NetRevenue AS DOUBLE) - 1.0) * 100.0 AS RevenueYoYPct,
       (CAST(a.Orders AS DOUBLE) / b.Orders - 1.0) * 100.0 AS OrdersYoYPct,
       (CAST(a.ActiveCustomers AS DOUBLE) / b.ActiveCustomers - 1.0) * 100.0 AS CustomersYoYPct,
       (a.AverageOrderValue / b.AverageOrderValue - 1.0) * 100.0 AS AOVYoYPct
FROM y a LEFT JOIN y b ON b.CalendarYear = a.CalendarYear - 1""",
)(lambda t: sales.annual_growth(t, START, END))
query(
    "m20_channel_by_year", "s: ChannelName f: Revenue1996 Revenue1997 Revenue1998 Revenue1999", "valid_orders", f"""
SELECT ChannelName, COALESCE(SUM(RevenueAfterRefund) FILTER (year(OrderDate) = 1996), 0) AS Revenue1996,
       COALESCE(SUM(RevenueAfterRefund) FILTER (year(OrderDate) = 1997), 0) AS Revenue1997,
       COALESCE(SUM(RevenueAfterRefund) FILTER (year(OrderDate) = 1998), 0) AS Revenue1998,
       COALESCE(SUM(RevenueAfterRefund) FILTER (year(OrderDate) = 1999), 0) AS Revenue1999
FROM valid_orders WHERE OrderDate BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY ChannelName""",
)(lambda t: sales.channel_by_year(t, START, END))

piece("second_orders", "valid_orders", """
SELECT CustomerId, OrderDate AS FirstOrderDate, NextOrderDate, NextOrderDate - OrderDate AS DaysToSecondOrder
FROM (SELECT *, LEAD(OrderDate) OVER (PARTITION BY CustomerId ORDER BY OrderDateTime, OrderId) AS NextOrderDate FROM valid_orders)
WHERE CustomerOrderNumber = 1""")
query(
    "m21_repeat_timing",
    "i: FirstTimeCustomers RepeatedWithin30Days RepeatedWithin60Days RepeatedWithin90Days f: AvgDaysToSecondOrder RepeatWithin90DayRate",
    "second_orders", """
SELECT COUNT(*) AS FirstTimeCustomers, COUNT(*) FILTER (DaysToSecondOrder <= 30) AS RepeatedWithin30Days,
       COUNT(*) FILTER (DaysToSecondOrder <= 60) AS RepeatedWithin60Days, COUNT(*) FILTER (DaysToSecondOrder <= 90) AS RepeatedWithin90Days,
       CAST(SUM(DaysToSecondOrder) AS DOUBLE) / COUNT(DaysToSecondOrder) AS AvgDaysToSecondOrder,
       CAST(COUNT(*) FILTER (DaysToSecondOrder <= 90) AS DOUBLE) / COUNT(*) AS RepeatWithin90DayRate FROM second_orders""",
)(customers.repeat_timing)
query(
    "m21b_repeat_flags",
    "i: CustomerId d: FirstOrderDate NextOrderDate i: DaysToSecondOrder RepeatedWithin30Days RepeatedWithin60Days RepeatedWithin90Days",
    "second_orders", """
SELECT *, CAST(COALESCE(DaysToSecondOrder <= 30, false) AS INTEGER) AS RepeatedWithin30Days,
       CAST(COALESCE(DaysToSecondOrder <= 60, false) AS INTEGER) AS RepeatedWithin60Days,
       CAST(COALESCE(DaysToSecondOrder <= 90, false) AS INTEGER) AS RepeatedWithin90Days FROM second_orders""",
)(customers.repeat_flags)
query(
    "w02_order_gaps", "i: OrderId CustomerId d: OrderDate PreviousOrderDate NextOrderDate i: GapDays", "valid_orders", """
SELECT OrderId, CustomerId, OrderDate, LAG(OrderDate) OVER w AS PreviousOrderDate, LEAD(OrderDate) OVER w AS NextOrderDate,
       OrderDate - LAG(OrderDate) OVER w AS GapDays FROM valid_orders WINDOW w AS (PARTITION BY CustomerId ORDER BY OrderDateTime, OrderId)""",
)(facts.order_neighbours)
query(
    "m22_churn_risk",
    "i: CustomerId s: SegmentName i: LifetimeOrders f: LifetimeRevenueAfterRefund AverageOrderValue AvgDaysBetweenOrders i: RecencyDays"
    " s: LifecycleStatus i: ValueRankWithinRisk",
    "customer_metrics", """
SELECT *, rank() OVER (PARTITION BY LifecycleStatus ORDER BY LifetimeRevenueAfterRefund DESC) AS ValueRankWithinRisk
FROM customer_metrics WHERE LifecycleStatus NOT IN ('Active', 'Prospect')""",
)(customers.churn_risk)
query(
    "m23_value_tiers",
    "i: CustomerId s: SegmentName i: LifetimeOrders f: LifetimeRevenueAfterRefund LifetimeGrossProfit Projected12MonthRevenue"
    " i: ProjectedValueDecile HistoricalValueRank",
    "customer_metrics", """
SELECT *, ntile(10) OVER (ORDER BY Projected12MonthRevenue, CustomerId) AS ProjectedValueDecile,
       dense_rank() OVER (ORDER BY LifetimeRevenueAfterRefund DESC) AS HistoricalValueRank FROM customer_metrics WHERE LifetimeOrders > 0""",
)(customers.value_tiers)
query(
    "m24_rfm_segments_percentile", _SEGMENTS, "rfm_base rfm_rules", """
WITH s AS (SELECT *, 6 - ceil(row_number() OVER (ORDER BY RecencyDays, CustomerId) * 5.0 / COUNT(*) OVER ()) AS r,
                  ceil(row_number() OVER (ORDER BY Frequency, CustomerId) * 5.0 / COUNT(*) OVER ()) AS f,
                  ceil(row_number() OVER (ORDER BY MonetaryValue, CustomerId) * 5.0 / COUNT(*) OVER ()) AS m FROM rfm_base),
g AS (SELECT s.CustomerId, RecencyDays, Frequency, MonetaryValue, arg_min(Segment, priority) AS Segment
      FROM s JOIN rfm_rules ON r BETWEEN r1 AND r2 AND f BETWEEN f1 AND f2 AND m BETWEEN m1 AND m2 GROUP BY ALL)
SELECT Segment, COUNT(*) AS Customers, CAST(SUM(RecencyDays) AS DOUBLE) / COUNT(*) AS AvgRecencyDays,
       CAST(SUM(Frequency) AS DOUBLE) / COUNT(*) AS AvgFrequency, SUM(MonetaryValue) AS SegmentValue FROM g GROUP BY Segment""",
)(lambda t: customers.rfm_summary(customers.rfm_snapshot(t, method="percentile")))
query(
    "m25_retention_curve", _COHORT + " PreviousMonthRetention", "cohort_retention", """
SELECT *, LAG(RetentionRate) OVER (PARTITION BY CohortMonth ORDER BY MonthsSinceFirstOrder) AS PreviousMonthRetention
FROM cohort_retention WHERE MonthsSinceFirstOrder <= 12""",
)(customers.retention_curve)
query(
    "m26_product_portfolio",
    "s: CategoryName i: ProductId s: ProductName i: Orders UnitsSold f: NetRevenue GrossProfit GrossMarginRate UnitReturnRate AverageRating"
    " i: RevenueRank ProfitRank ReturnQualityRowNumber",
    "product_performance", """
SELECT *, dense_rank() OVER (PARTITION BY CategoryName ORDER BY NetRevenue DESC) AS RevenueRank,
       dense_rank() OVER (PARTITION BY CategoryName ORDER BY GrossProfit DESC) AS ProfitRank,
       row_number() OVER (PARTITION BY CategoryName ORDER BY UnitReturnRate, ProductId) AS ReturnQualityRowNumber
FROM product_performance WHERE Orders >= 25 QUALIFY RevenueRank <= 5 OR ProfitRank <= 5""",
)(products.product_portfolio)
query(
    "m27_category_returns",
    "s: CategoryName i: UnitsSold ReturnedUnits f: RefundAmount NetRevenue GrossProfit UnitReturnRate RefundToRevenueRate i: RefundExposureRank",
    "product_performance", """
SELECT *, CAST(ReturnedUnits AS DOUBLE) / NULLIF(CAST(UnitsSold AS DOUBLE), 0) AS UnitReturnRate,
       CAST(RefundAmount AS DOUBLE) / NULLIF(CAST(NetRevenue AS DOUBLE), 0) AS RefundToRevenueRate, rank() OVER (ORDER BY RefundAmount DESC) AS RefundExposureRank
FROM (SELECT CategoryName, SUM(UnitsSold) AS UnitsSold, SUM(ReturnedUnits) AS ReturnedUnits, SUM(RefundAmount) AS RefundAmount,
             SUM(NetRevenue) AS NetRevenue, SUM(GrossProfit) AS GrossProfit FROM product_performance GROUP BY CategoryName)""",
)(products.category_returns)
piece("category_performance", "product_performance", """
SELECT *, CAST(GrossProfit AS DOUBLE) / NULLIF(CAST(NetRevenue AS DOUBLE), 0) AS GrossMarginRate,
       CAST(ReturnedUnits AS DOUBLE) / NULLIF(CAST(UnitsSold AS DOUBLE), 0) AS UnitReturnRate,
       CAST(RefundAmount AS DOUBLE) / NULLIF(CAST(NetRevenue AS DOUBLE), 0) AS RefundToRevenueRate
FROM (SELECT CategoryName, COUNT(*) AS Products, SUM(Orders) AS Orders, SUM(UnitsSold) AS UnitsSold, SUM(NetRevenue) AS NetRevenue,
             SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfit) AS GrossProfit, SUM(ReturnedUnits) AS ReturnedUnits,
             SUM(RefundAmount) AS RefundAmount, SUM(DiscountAmount) AS DiscountAmount FROM product_performance GROUP BY CategoryName)""")
query(
    "m27b_category_performance",
    "s: CategoryName i: Products Orders UnitsSold f: NetRevenue RevenueAfterRefund GrossProfit i: ReturnedUnits f: RefundAmount DiscountAmount"
    " GrossMarginRate UnitReturnRate RefundToRevenueRate",
    "category_performance", "SELECT * FROM category_performance",
)(products.category_performance)
_RISK = "s: Carrier Region i: DeliveredOrders f: AvgDeliveryDays OnTimeRate i: LateOrders ServiceRiskRank"


def _risk_sql(minimum: int) -> str:
    return f"""
SELECT *, rank() OVER (ORDER BY OnTimeRate, AvgDeliveryDays DESC) AS ServiceRiskRank
FROM (SELECT Carrier, Region, COUNT(*) AS DeliveredOrders, CAST(SUM(DeliveryDays) AS DOUBLE) / COUNT(*) AS AvgDeliveryDays,
             CAST(SUM(IsOnTime) AS DOUBLE) / COUNT(*) AS OnTimeRate, COUNT(*) FILTER (IsOnTime = 0) AS LateOrders
      FROM order_summary WHERE DeliveredDate IS NOT NULL GROUP BY Carrier, Region HAVING COUNT(*) >= {minimum})"""


query("m28_delivery_risk", _RISK, "order_summary", _risk_sql(100))(operations.delivery_risk)
query("m28b_delivery_risk_250", _RISK, "order_summary", _risk_sql(250))(
    lambda t: operations.delivery_risk(t, min_orders=250)
)
piece("lanes", "valid_orders", """
SELECT Carrier, Region, COUNT(*) AS DeliveredOrders, CAST(SUM(DeliveryDays) AS DOUBLE) / COUNT(*) AS AverageDeliveryDays,
       median(DeliveryDays) AS MedianDeliveryDays, CAST(SUM(IsOnTime) AS DOUBLE) / COUNT(*) AS OnTimeRate,
       COUNT(*) FILTER (IsOnTime = 0) AS LateOrders
FROM valid_orders WHERE DeliveredDate IS NOT NULL GROUP BY Carrier, Region""")
query(
    "m28c_delivery_performance",
    "s: Carrier Region i: DeliveredOrders f: AverageDeliveryDays MedianDeliveryDays OnTimeRate i: LateOrders", "lanes", "SELECT * FROM lanes",
)(operations.delivery_performance)
query(
    "m29_campaign_economics",
    "s: PromotionCode PromotionName i: Audience Clicks Conversions f: ClickThroughRate ClickToConversionRate i: AttributedOrders"
    " f: AttributedRevenueAfterRefund AttributedGrossProfit DiscountCost GrossProfitPerDiscountDollar i: CampaignProfitRank",
    "campaign_performance", """
SELECT *, CAST(AttributedGrossProfit AS DOUBLE) / NULLIF(CAST(DiscountCost AS DOUBLE), 0) AS GrossProfitPerDiscountDollar,
       dense_rank() OVER (ORDER BY AttributedGrossProfit DESC) AS CampaignProfitRank FROM campaign_performance""",
)(marketing.campaign_economics)
piece("discounts", "valid_orders", """
SELECT MonthStart, ChannelName, CASE WHEN PromotionId IS NULL THEN 'No Promotion' ELSE 'Promotion' END AS PromotionGroup, COUNT(*) AS Orders,
       CAST(SUM(NetRevenue) AS DOUBLE) / COUNT(*) AS AverageOrderValue, SUM(RevenueAfterRefund) AS RevenueAfterRefund,
       SUM(GrossProfit) AS GrossProfit, SUM(DiscountAmount) AS DiscountCost, CAST(SUM(GrossProfit) AS DOUBLE) / COUNT(*) AS GrossProfitPerOrder
FROM valid_orders GROUP BY ALL""")
query(
    "m30_discount_comparison",
    "d: MonthStart s: ChannelName i: PromotionOrders NonPromotionOrders f: PromotionAOV NonPromotionAOV PromotionGrossProfit PromotionDiscountCost",
    "discounts", """
SELECT MonthStart, ChannelName, COALESCE(p.Orders, 0) AS PromotionOrders, COALESCE(n.Orders, 0) AS NonPromotionOrders,
       p.AverageOrderValue AS PromotionAOV, n.AverageOrderValue AS NonPromotionAOV, COALESCE(p.GrossProfit, 0) AS PromotionGrossProfit,
       COALESCE(p.DiscountCost, 0) AS PromotionDiscountCost
FROM (SELECT * FROM discounts WHERE PromotionGroup = 'Promotion') p
FULL JOIN (SELECT * FROM discounts WHERE PromotionGroup = 'No Promotion') n USING (MonthStart, ChannelName)""",
)(marketing.discount_comparison)
query(
    "m31_discount_effectiveness",
    "d: MonthStart s: ChannelName PromotionGroup i: Orders f: AverageOrderValue RevenueAfterRefund GrossProfit DiscountCost GrossProfitPerOrder",
    "discounts", "SELECT * FROM discounts",
)(lambda t: marketing.discount_effectiveness(facts.valid_orders(t)))
query(
    "m32_regional_contribution",
    "s: Region StateProvince i: Orders Customers f: NetRevenue GrossProfit i: RepeatOrders f: RevenueShare GrossMarginRate RepeatOrderRate"
    " i: RevenueRank",
    "valid_orders", """
WITH g AS (SELECT Region, StateProvince, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS Customers, SUM(NetRevenue) AS NetRevenue,
                  SUM(GrossProfit) AS GrossProfit, SUM(IsRepeatPurchase) AS RepeatOrders FROM valid_orders GROUP BY ALL)
SELECT *, CAST(NetRevenue AS DOUBLE) / (SELECT CAST(SUM(NetRevenue) AS DOUBLE) FROM g) AS RevenueShare,
       CAST(GrossProfit AS DOUBLE) / CAST(NetRevenue AS DOUBLE) AS GrossMarginRate, CAST(RepeatOrders AS DOUBLE) / Orders AS RepeatOrderRate,
       rank() OVER (ORDER BY NetRevenue DESC) AS RevenueRank FROM g""",
)(sales.regional_contribution)
piece("pareto", "customer_metrics", """
SELECT CustomerId, LifetimeRevenueAfterRefund, CustomerRank, CAST(CustomerRank AS DOUBLE) / COUNT(*) OVER () AS CumulativeCustomerShare,
       CAST(running AS DOUBLE) / CAST(total AS DOUBLE) AS CumulativeRevenueShare, running * 100 >= total * 80 AS reached
FROM (SELECT *, row_number() OVER w AS CustomerRank, SUM(LifetimeRevenueAfterRefund) OVER (w ROWS UNBOUNDED PRECEDING) AS running,
             SUM(LifetimeRevenueAfterRefund) OVER () AS total
      FROM customer_metrics WHERE LifetimeRevenueAfterRefund > 0 WINDOW w AS (ORDER BY LifetimeRevenueAfterRefund DESC, CustomerId))""")
query(
    "m33_pareto_threshold", "i: CustomersRequired f: CustomerShareRequired RevenueShareReached", "pareto", """
SELECT CustomerRank AS CustomersRequired, CumulativeCustomerShare AS CustomerShareRequired, CumulativeRevenueShare AS RevenueShareReached
FROM pareto WHERE reached ORDER BY CustomerRank LIMIT 1""",
)(concentration.pareto_threshold)
query(
    "m34_pareto_curve", "i: CustomerId f: LifetimeRevenueAfterRefund i: CustomerRank f: CumulativeCustomerShare CumulativeRevenueShare",
    "pareto", "SELECT * FROM pareto",
)(concentration.pareto_curve)
piece("acquisition", "valid_orders customers", """
SELECT *, CAST(Customers AS DOUBLE) / NULLIF(AcquiredCustomers, 0) AS PurchaserConversionRate,
       CAST(RevenueAfterRefund AS DOUBLE) / NULLIF(Customers, 0) AS RevenuePerPurchaser, CAST(RepeatOrders AS DOUBLE) / NULLIF(Orders, 0) AS RepeatOrderRate
FROM (SELECT c.AcquisitionSource, COUNT(DISTINCT o.CustomerId) AS Customers, COUNT(o.OrderId) AS Orders,
             COALESCE(SUM(RevenueAfterRefund), 0) AS RevenueAfterRefund, COALESCE(SUM(GrossProfit), 0) AS GrossProfit,
             COALESCE(CAST(SUM(NetRevenue) AS DOUBLE) / NULLIF(COUNT(o.OrderId), 0), 0) AS AverageOrderValue,
             COALESCE(SUM(IsRepeatPurchase), 0) AS RepeatOrders, COUNT(DISTINCT c.CustomerId) AS AcquiredCustomers
      FROM customers c LEFT JOIN valid_orders o USING (CustomerId) GROUP BY c.AcquisitionSource)""")
query(
    "m35_acquisition_performance",
    "s: AcquisitionSource i: Customers Orders f: RevenueAfterRefund GrossProfit AverageOrderValue i: RepeatOrders AcquiredCustomers"
    " f: PurchaserConversionRate RevenuePerPurchaser RepeatOrderRate",
    "acquisition", "SELECT * FROM acquisition",
)(marketing.acquisition_performance)
query(
    "m36_region_channel",
    "s: Region ChannelName i: Orders Customers f: RevenueAfterRefund GrossProfit i: RepeatOrders f: GrossMarginRate RepeatOrderRate",
    "valid_orders", """
SELECT Region, ChannelName, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS Customers, SUM(RevenueAfterRefund) AS RevenueAfterRefund,
       SUM(GrossProfit) AS GrossProfit, SUM(IsRepeatPurchase) AS RepeatOrders,
       CAST(SUM(GrossProfit) AS DOUBLE) / NULLIF(CAST(SUM(RevenueAfterRefund) AS DOUBLE), 0) AS GrossMarginRate,
       CAST(SUM(IsRepeatPurchase) AS DOUBLE) / COUNT(*) AS RepeatOrderRate FROM valid_orders GROUP BY ALL""",
)(sales.region_channel)
piece("ratings", "reviews refunds", """
SELECT Rating, COUNT(*) AS Reviews, COUNT(*) FILTER (OrderItemId IN (SELECT OrderItemId FROM refunds)) AS ReturnedReviews,
       CAST(COUNT(*) FILTER (OrderItemId IN (SELECT OrderItemId FROM refunds)) AS DOUBLE) / COUNT(*) AS ReturnRate
FROM reviews GROUP BY Rating""")
query("m37_rating_returns", "i: Rating Reviews ReturnedReviews f: ReturnRate", "ratings", "SELECT * FROM ratings")(
    operations.rating_returns
)
piece("season", "monthly_kpis", """
SELECT MonthNumber, CAST(SUM(RevenueAfterRefund) AS DOUBLE) / COUNT(*) AS AverageMonthlyRevenue, CAST(SUM(Orders) AS DOUBLE) / COUNT(*) AS AverageOrders,
       (CAST(SUM(RevenueAfterRefund) AS DOUBLE) / COUNT(*)) / (SELECT CAST(SUM(RevenueAfterRefund) AS DOUBLE) / COUNT(*) FROM monthly_kpis)
         AS RevenueSeasonalityIndex
FROM monthly_kpis GROUP BY MonthNumber""")
query(
    "m38_seasonality", "i: MonthNumber f: AverageMonthlyRevenue AverageOrders RevenueSeasonalityIndex", "season", "SELECT * FROM season"
)(sales.seasonality)
piece("churn", "customer_metrics", """
SELECT LifecycleStatus, COUNT(*) AS Customers, SUM(LifetimeRevenueAfterRefund) AS RevenueAtRisk,
       SUM(Projected12MonthRevenue) AS Projected12MonthRevenue, CAST(SUM(RecencyDays) AS DOUBLE) / NULLIF(COUNT(RecencyDays), 0) AS AverageRecencyDays
FROM customer_metrics GROUP BY LifecycleStatus""")
query(
    "m39_churn_summary", "s: LifecycleStatus i: Customers f: RevenueAtRisk Projected12MonthRevenue AverageRecencyDays", "churn", "SELECT * FROM churn"
)(customers.churn_summary)
query("a15_lifecycle_counts", "s: LifecycleStatus i: Customers", "churn", "SELECT * FROM churn")(
    customers.lifecycle_counts
)
piece("scorecard", "order_summary valid_orders customer_metrics monthly_performance", """
SELECT (SELECT MAX(OrderDate) FROM order_summary) AS AsOfDate, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS CustomersWithOrders,
       SUM(NetRevenue) AS NetRevenue, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfit) AS GrossProfit,
       CAST(SUM(GrossProfit) AS DOUBLE) / CAST(SUM(NetRevenue) AS DOUBLE) AS GrossMarginRate, CAST(SUM(NetRevenue) AS DOUBLE) / COUNT(*) AS AverageOrderValue,
       CAST(SUM(IsRepeatPurchase) AS DOUBLE) / COUNT(*) AS RepeatOrderRate,
       (SELECT CAST(SUM(IsRepeatCustomer) AS DOUBLE) / COUNT(*) FROM customer_metrics) AS RepeatCustomerRate,
       CAST(SUM(RefundAmount) AS DOUBLE) / CAST(SUM(NetRevenue) AS DOUBLE) AS RefundLeakageRate,
       CAST(SUM(IsOnTime) AS DOUBLE) / COUNT(DeliveredDate) AS OnTimeDeliveryRate,
       (SELECT CAST(NetRevenue AS DOUBLE) / NULLIF(CAST(PreviousYearRevenue AS DOUBLE), 0) - 1 FROM monthly_performance ORDER BY MonthStart DESC LIMIT 1)
         AS LatestMonthYoYGrowth
FROM valid_orders""")
query(
    "m40_executive_scorecard",
    "d: AsOfDate i: Orders CustomersWithOrders f: NetRevenue RevenueAfterRefund GrossProfit GrossMarginRate AverageOrderValue RepeatOrderRate"
    " RepeatCustomerRate RefundLeakageRate OnTimeDeliveryRate LatestMonthYoYGrowth",
    "scorecard", "SELECT * FROM scorecard",
)(insights.executive_scorecard)
query(
    "m41_insights", "i: Priority s: Finding Subject f: Value Comparison",
    "scorecard season acquisition cohort_retention churn category_performance lanes campaign_performance pareto ratings discounts", """
SELECT 1 AS Priority, 'refund_leakage' AS Finding, NULL AS Subject, CAST(RevenueAfterRefund AS DOUBLE) AS Value, RefundLeakageRate AS Comparison FROM scorecard
UNION ALL SELECT 2, 'latest_year_over_year', NULL, LatestMonthYoYGrowth, NULL FROM scorecard
UNION ALL SELECT 3, 'seasonal_peak', CAST(arg_max(MonthNumber, RevenueSeasonalityIndex) AS VARCHAR), MAX(RevenueSeasonalityIndex), NULL FROM season
UNION ALL SELECT 4, 'best_acquisition_source', arg_max(AcquisitionSource, RevenuePerPurchaser), MAX(RevenuePerPurchaser), NULL FROM acquisition
UNION ALL SELECT 5, 'repeat_behavior', NULL, RepeatCustomerRate, RepeatOrderRate FROM scorecard
UNION ALL SELECT 6, 'month_one_retention', NULL, round(AVG(RetentionRate), 9), NULL FROM cohort_retention WHERE MonthsSinceFirstOrder = 1
UNION ALL SELECT 7, 'revenue_at_risk', NULL, CAST(SUM(RevenueAtRisk) AS DOUBLE), NULL FROM churn WHERE LifecycleStatus IN ('At Risk', 'High Risk')
UNION ALL SELECT 8, 'profit_category', arg_max(CategoryName, GrossProfit), CAST(MAX(GrossProfit) AS DOUBLE), arg_max(GrossMarginRate, GrossProfit) FROM category_performance
UNION ALL SELECT 9, 'return_category', arg_max(CategoryName, UnitReturnRate), MAX(UnitReturnRate), CAST(arg_max(RefundAmount, UnitReturnRate) AS DOUBLE) FROM category_performance
UNION ALL SELECT 10, 'weakest_lane', Carrier || ' / ' || Region, OnTimeRate, CAST(DeliveredOrders AS DOUBLE)
  FROM (SELECT * FROM lanes WHERE DeliveredOrders >= 100 ORDER BY OnTimeRate, AverageDeliveryDays, Carrier, Region LIMIT 1)
UNION ALL SELECT 11, 'profit_campaign', arg_max(PromotionName, AttributedGrossProfit), CAST(MAX(AttributedGrossProfit) AS DOUBLE), NULL FROM campaign_performance
UNION ALL SELECT 12, 'concentration', NULL, MIN(CumulativeCustomerShare), NULL FROM pareto WHERE reached
UNION ALL SELECT 13, 'low_rating_returns', NULL, CAST(SUM(ReturnedReviews) FILTER (Rating <= 2) AS DOUBLE) / CAST(SUM(Reviews) FILTER (Rating <= 2) AS DOUBLE),
  CAST(SUM(ReturnedReviews) FILTER (Rating >= 4) AS DOUBLE) / CAST(SUM(Reviews) FILTER (Rating >= 4) AS DOUBLE) FROM ratings
UNION ALL SELECT 14, 'promotion_profit_delta', NULL,
  (CAST(SUM(GrossProfit) FILTER (PromotionGroup = 'Promotion') AS DOUBLE) / CAST(SUM(Orders) FILTER (PromotionGroup = 'Promotion') AS DOUBLE))
  / (CAST(SUM(GrossProfit) FILTER (PromotionGroup <> 'Promotion') AS DOUBLE) / CAST(SUM(Orders) FILTER (PromotionGroup <> 'Promotion') AS DOUBLE)) - 1, NULL FROM discounts""",
)(insights.insights)

_MATRIX = " ".join(f"M{m}" for m in range(13))
query(
    "a12_cohort_matrix", f"d: CohortMonth f: {_MATRIX}", "cohort_retention",
    "SELECT CohortMonth, "
    + ", ".join(f"MAX(RetentionRate) FILTER (MonthsSinceFirstOrder = {m}) AS M{m}" for m in range(13))
    + " FROM cohort_retention WHERE CohortMonth IN (SELECT DISTINCT CohortMonth FROM cohort_retention WHERE MonthsSinceFirstOrder <= 12"
    " ORDER BY 1 DESC LIMIT 18) AND MonthsSinceFirstOrder <= 12 GROUP BY CohortMonth",
)(lambda t: customers.cohort_matrix(t, months=12, cohorts=18))


@query(
    "h1_global_order",
    "i: CustomerId Quartile RowNumber Rank DenseRank f: Running i: Total", "rfm_base", """
SELECT CustomerId, ntile(4) OVER w AS Quartile, row_number() OVER w AS RowNumber, rank() OVER (ORDER BY Frequency) AS Rank,
       dense_rank() OVER (ORDER BY Frequency) AS DenseRank, SUM(MonetaryValue) OVER (w ROWS UNBOUNDED PRECEDING) AS Running,
       COUNT(*) OVER () AS Total FROM rfm_base WINDOW w AS (ORDER BY Frequency, CustomerId)""",
)
def _global_order(t):
    ordering = Ordering(
        "Frequency",
        row_number="RowNumber",
        rank="Rank",
        dense_rank="DenseRank",
        running_sums={"Running": "MonetaryValue"},
        ntiles={"Quartile": 4},
        total="Total",
    )
    return order_globally(customers.rfm_base(t), "CustomerId", [ordering])


query(
    "s11_calendar",
    "i: DateKey d: FullDate i: CalendarYear CalendarQuarter MonthNumber s: MonthName YearMonth i: WeekOfYear DayOfMonth s: DayName i: IsWeekend",
    "calendar", "SELECT * FROM calendar",
)(lambda t: t["date_dimension"])
