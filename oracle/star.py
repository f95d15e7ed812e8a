"""Star schema e01 to e07, measures x01 to x20, report pages x21."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.catalog import query
from oracle.prelude import piece
from orderwell.plans import measures, pages, star
from orderwell.plans.measures import evaluate
from orderwell.plans.star import Star


def tidy(df):
    """Measure names as column names: no spaces, signs spelled out."""
    names = {c: c.replace("%", "Pct").replace(" ", "").replace("-", "") for c in df.columns}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def measure_query(name, columns, needs, sql, names, group_by=(), filters=()):
    query(name, columns, needs, sql)(lambda t: tidy(evaluate(Star(t), names, group_by, filters)))


def D(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def div(top: str, bottom: str) -> str:
    return f"{D(top)} / NULLIF({D(bottom)}, 0)"


YM = "strftime(OrderDate, '%Y-%m')"

query(
    "e01_dim_geography", "i: GeographyKey s: City StateProvince Region CountryCode", "order_summary", """
SELECT row_number() OVER (ORDER BY CountryCode, Region, StateProvince, City) AS GeographyKey, * FROM
  (SELECT DISTINCT City, StateProvince, Region, CountryCode FROM order_summary)""",
)(star.dim_geography)
piece("geo", "order_summary", """
SELECT row_number() OVER (ORDER BY CountryCode, Region, StateProvince, City) AS GeographyKey, * FROM
  (SELECT DISTINCT City, StateProvince, Region, CountryCode FROM order_summary)""")
query(
    "e02_fact_orders",
    "i: OrderId OrderDateKey d: OrderDate i: CustomerId CustomerOrderNumber IsRepeatPurchase ChannelId GeographyKey s: StatusName i: Units"
    " f: GrossRevenue DiscountAmount NetRevenue RevenueAfterRefund GrossProfit GrossProfitAfterRefund RefundAmount i: ReturnedUnits PromotionId"
    " s: Carrier d: ShippedDate PromisedDeliveryDate DeliveredDate i: DeliveryDays IsOnTime",
    "order_summary geo", "SELECT * FROM order_summary JOIN geo USING (City, StateProvince, Region, CountryCode)",
)(lambda t: Star(t)["FactOrders"])
query(
    "e02b_fact_order_lines",
    "s: OrderItemId i: OrderId OrderDateKey CustomerId ProductId Quantity f: UnitPrice UnitCost GrossRevenue DiscountAmount NetRevenue"
    " RevenueAfterRefund COGS GrossProfit GrossProfitAfterRefund i: ReturnedQuantity f: RefundAmount DiscountRate i: IsValidOrder ChannelId"
    " PromotionId GeographyKey",
    "order_lines geo", "SELECT * FROM order_lines JOIN geo USING (City, StateProvince, Region, CountryCode)",
)(lambda t: Star(t)["FactOrderLines"])
query(
    "e03_dim_products",
    "i: ProductId s: SKU ProductName BrandName i: CategoryId f: UnitCost ListPrice d: LaunchDate i: IsActive s: SubcategoryName"
    " i: ParentCategoryId s: CategoryName",
    "products", "SELECT * FROM products",
)(lambda t: Star(t)["DimProduct"])
query(
    "e04_date_keys", "s: Source i: DateKey Rows", "b_orders b_returns reviews promotions",
    " UNION ALL ".join(
        f"SELECT '{s}' AS Source, CAST(strftime({c}, '%Y%m%d') AS INTEGER) AS DateKey, COUNT(*) AS Rows FROM {t} GROUP BY ALL"
        for s, t, c in [("order", "b_orders", "OrderDate"), ("return", "b_returns", "ReturnDate"), ("review", "reviews", "ReviewDate"),
                        ("campaign_start", "promotions", "StartDate"), ("campaign_end", "promotions", "EndDate")]),
)(star.date_keys)
query(
    "e05_fact_reviews",
    "s: ReviewId i: ReviewDateKey t: ReviewDate i: CustomerId ProductId s: OrderItemId i: Rating IsVerifiedPurchase HelpfulVotes WasReturned",
    "reviews refunds", """
SELECT *, CAST(strftime(ReviewDate, '%Y%m%d') AS INTEGER) AS ReviewDateKey,
       CAST(OrderItemId IN (SELECT OrderItemId FROM refunds) AS INTEGER) AS WasReturned FROM reviews""",
)(lambda t: Star(t)["FactReviews"])
query(
    "e05b_dim_customers",
    "i: CustomerId d: AcquisitionDate s: AcquisitionSource SegmentName i: IsActive d: FirstOrderDate LastOrderDate i: LifetimeOrders"
    " f: LifetimeRevenue LifetimeRevenueAfterRefund LifetimeGrossProfit AverageOrderValue AvgDaysBetweenOrders i: RecencyDays IsRepeatCustomer"
    " f: Projected12MonthRevenue s: LifecycleStatus",
    "customer_metrics", "SELECT * FROM customer_metrics",
)(lambda t: Star(t)["DimCustomer"])

_FACTS = {
    "FactOrders": ("order_summary", {"DimDate": "OrderDateKey", "DimCustomer": "CustomerId", "DimChannel": "ChannelId", "DimPromotion": "PromotionId"}),
    "FactOrderLines": ("order_lines", {"DimDate": "OrderDateKey", "DimCustomer": "CustomerId", "DimProduct": "ProductId", "DimChannel": "ChannelId",
                                       "DimPromotion": "PromotionId"}),
    "FactReviews": ("(SELECT *, CAST(strftime(ReviewDate, '%Y%m%d') AS INTEGER) AS ReviewDateKey FROM reviews)",
                    {"DimDate": "ReviewDateKey", "DimCustomer": "CustomerId", "DimProduct": "ProductId"}),
    "FactReturns": ("(SELECT r.*, CAST(strftime(ReturnDate, '%Y%m%d') AS INTEGER) AS ReturnDateKey, h.CustomerId, h.ChannelId, h.PromotionId, h.AddressId, i.ProductId"
                    " FROM b_returns r JOIN headers h USING (OrderId) JOIN return_items x USING (ReturnId) JOIN items i ON i.OrderItemId = x.OrderItemId)",
                    {"DimDate": "ReturnDateKey", "DimCustomer": "CustomerId", "DimProduct": "ProductId", "DimChannel": "ChannelId", "DimPromotion": "PromotionId"}),
    "FactCampaignPerformance": ("(SELECT *, CAST(strftime(StartDate, '%Y%m%d') AS INTEGER) AS StartDateKey FROM campaign_performance)",
                                {"DimDate": "StartDateKey", "DimPromotion": "PromotionId"}),
    "FactRfmSnapshot": ("(SELECT *, CAST(strftime(SnapshotDate, '%Y%m%d') AS INTEGER) AS SnapshotDateKey FROM rfm_base)",
                        {"DimDate": "SnapshotDateKey", "DimCustomer": "CustomerId"}),
}
_PLACED = "LEFT JOIN geo USING (City, StateProvince, Region, CountryCode)"
_FACTS["FactOrders"] = (f"(SELECT * FROM order_summary {_PLACED})", _FACTS["FactOrders"][1] | {"DimGeography": "GeographyKey"})
_FACTS["FactOrderLines"] = (f"(SELECT * FROM order_lines {_PLACED})", _FACTS["FactOrderLines"][1] | {"DimGeography": "GeographyKey"})
_FACTS["FactReturns"] = (
    f"(SELECT * FROM {_FACTS['FactReturns'][0]} JOIN (SELECT * EXCLUDE (CustomerId) FROM addresses) USING (AddressId) {_PLACED})",
    _FACTS["FactReturns"][1] | {"DimGeography": "GeographyKey"},
)
_DIMS = {"DimDate": ("calendar", "DateKey"), "DimCustomer": ("customers", "CustomerId"), "DimProduct": ("products", "ProductId"),
         "DimChannel": ("channels", "ChannelId"), "DimPromotion": ("promotions", "PromotionId"), "DimGeography": ("geo", "GeographyKey")}
_AUDITED = (
    "order_summary order_lines reviews b_returns headers return_items items campaign_performance rfm_base calendar customers products channels promotions"
    " geo addresses"
)


def _audit(facts: dict, dims: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dim}_{fact}' AS Relationship, (SELECT COUNT(*) FROM (SELECT 1 FROM {dims[dim][0]} GROUP BY {dims[dim][1]} HAVING COUNT(*) > 1)) AS DuplicateKeys,"
        f" COUNT(*) FILTER (k IS NOT NULL AND k NOT IN (SELECT {dims[dim][1]} FROM {dims[dim][0]})) AS Orphans FROM (SELECT {key} AS k FROM {source})"
        for fact, (source, keys) in facts.items() for dim, key in keys.items()
    )


query("e07_relationship_audit", "s: Relationship i: DuplicateKeys Orphans", _AUDITED, _audit(_FACTS, _DIMS))(
    lambda t: star.relationship_audit(Star(t))
)


@query(
    "e07b_audit_of_broken_star", "s: Relationship i: DuplicateKeys Orphans", _AUDITED,
    _audit(
        _FACTS | {"FactReviews": (_FACTS["FactReviews"][0].replace("SELECT *", "SELECT * REPLACE (ProductId * 5 - 3 AS ProductId)"), _FACTS["FactReviews"][1])},
        _DIMS | {
            "DimCustomer": ("(SELECT CustomerId FROM customers UNION ALL SELECT CustomerId FROM customers WHERE CustomerId % 7 = 0)", "CustomerId"),
            "DimChannel": ("(SELECT * FROM channels WHERE ChannelId <> 2)", "ChannelId"),
            "DimGeography": ("(SELECT * FROM geo WHERE GeographyKey % 3 <> 0)", "GeographyKey"),
        },
    ),
)
def broken_star(t):
    """Customers twice, a channel and places gone, reviews of products that do not exist."""
    built = Star(t)
    tables = {name: built[name] for fact, _, dim, _ in star.RELATIONSHIPS for name in (fact, dim)}
    people = built["DimCustomer"]
    return star.relationship_audit(tables | {
        "DimCustomer": people.unionByName(people.where("CustomerId % 7 = 0")),
        "DimChannel": built["DimChannel"].where("ChannelId <> 2"),
        "DimGeography": built["DimGeography"].where("GeographyKey % 3 <> 0"),
        "FactReviews": built["FactReviews"].withColumn("ProductId", F.expr("ProductId * 5 - 3")),
    })


# ----------------------------------------------------------------- measures
CHANNEL, REGION = ("DimChannel", "ChannelName"), ("DimGeography", "Region")
measure_query(
    "x01_base_sums", "s: ChannelName f: Revenue RevenueAfterRefund GrossRevenue DiscountAmount RefundAmount GrossProfit GrossProfitAfterRefund",
    "order_summary", """
SELECT ChannelName, SUM(NetRevenue) AS Revenue, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossRevenue) AS GrossRevenue,
       SUM(DiscountAmount) AS DiscountAmount, SUM(RefundAmount) AS RefundAmount, SUM(GrossProfit) AS GrossProfit,
       SUM(GrossProfitAfterRefund) AS GrossProfitAfterRefund FROM order_summary GROUP BY ChannelName""",
    ["Revenue", "Revenue After Refund", "Gross Revenue", "Discount Amount", "Refund Amount", "Gross Profit", "Gross Profit After Refund"], [CHANNEL],
)
measure_query(
    "x02_ratios", "s: Region f: GrossMarginPct GrossMarginAfterRefundPct DiscountRate RefundRate", "order_summary", f"""
SELECT Region, {div('SUM(GrossProfit)', 'SUM(NetRevenue)')} AS GrossMarginPct,
       {div('SUM(GrossProfitAfterRefund)', 'SUM(RevenueAfterRefund)')} AS GrossMarginAfterRefundPct,
       {div('SUM(DiscountAmount)', 'SUM(GrossRevenue)')} AS DiscountRate, {div('SUM(RefundAmount)', 'SUM(NetRevenue)')} AS RefundRate
FROM order_summary GROUP BY Region""",
    ["Gross Margin %", "Gross Margin After Refund %", "Discount Rate", "Refund Rate"], [REGION],
)
measure_query(
    "x03_orders_customers",
    "s: SegmentName i: Orders UnitsSold ActiveCustomers RepeatOrders RepeatCustomers f: RepeatOrderRate AverageOrderValue RevenueperActiveCustomer",
    "valid_orders", f"""
SELECT SegmentName, COUNT(*) AS Orders, SUM(Units) AS UnitsSold, COUNT(DISTINCT CustomerId) AS ActiveCustomers, SUM(IsRepeatPurchase) AS RepeatOrders,
       COUNT(DISTINCT CustomerId) FILTER (IsRepeatPurchase = 1) AS RepeatCustomers, {div('SUM(IsRepeatPurchase)', 'COUNT(*)')} AS RepeatOrderRate,
       {div('SUM(NetRevenue)', 'COUNT(*)')} AS AverageOrderValue, {div('SUM(RevenueAfterRefund)', 'COUNT(DISTINCT CustomerId)')} AS RevenueperActiveCustomer
FROM valid_orders GROUP BY SegmentName""",
    ["Orders", "Units Sold", "Active Customers", "Repeat Orders", "Repeat Customers", "Repeat Order Rate", "Average Order Value",
     "Revenue per Active Customer"], [("DimCustomer", "SegmentName")],
)
query(
    "x03b_filtered", "s: ChannelName i: Orders ActiveCustomers f: AverageOrderValue", "valid_orders", f"""
SELECT ChannelName, COUNT(*) AS Orders, COUNT(DISTINCT CustomerId) AS ActiveCustomers, {div('SUM(NetRevenue)', 'COUNT(*)')} AS AverageOrderValue
FROM valid_orders WHERE year(OrderDate) = 1998 AND Region = 'EUROPE' AND SegmentName <> 'MACHINERY' GROUP BY ChannelName""",
)(lambda t: tidy(evaluate(
    Star(t), ["Orders", "Active Customers", "Average Order Value"], [CHANNEL],
    [("DimDate", F.col("CalendarYear") == 1998), ("DimGeography", F.col("Region") == "EUROPE"), ("DimCustomer", F.col("SegmentName") != "MACHINERY")],
)))
query(
    "x04_new_customers", "s: YearMonth i: NewCustomers", "customer_metrics", """
SELECT strftime(FirstOrderDate, '%Y-%m') AS YearMonth, COUNT(*) AS NewCustomers FROM customer_metrics WHERE FirstOrderDate IS NOT NULL GROUP BY 1""",
)(lambda t: tidy(measures.new_customers(Star(t))))
measure_query(
    "x05_customer_value", "s: SegmentName f: AverageHistoricalCLV Projected12MCustomerValue i: CustomersatRisk f: ChurnIndicatorPct RevenueatRisk",
    "customer_metrics", f"""
SELECT SegmentName, {div('SUM(LifetimeRevenueAfterRefund) FILTER (LifetimeOrders > 0)', 'COUNT(*) FILTER (LifetimeOrders > 0)')} AS AverageHistoricalCLV,
       {div('SUM(Projected12MonthRevenue) FILTER (LifetimeOrders > 0)', 'COUNT(*) FILTER (LifetimeOrders > 0)')} AS Projected12MCustomerValue,
       NULLIF(COUNT(*) FILTER (LifecycleStatus LIKE '%Risk'), 0) AS CustomersatRisk,
       {div("COUNT(*) FILTER (LifecycleStatus LIKE '%Risk')", 'COUNT(*) FILTER (LifetimeOrders > 0)')} AS ChurnIndicatorPct,
       SUM(LifetimeRevenueAfterRefund) FILTER (LifecycleStatus LIKE '%Risk') AS RevenueatRisk FROM customer_metrics GROUP BY SegmentName""",
    ["Average Historical CLV", "Projected 12M Customer Value", "Customers at Risk", "Churn Indicator %", "Revenue at Risk"],
    [("DimCustomer", "SegmentName")],
)
measure_query(
    "x06_product_measures", "s: BrandName f: ProductRevenue ProductGrossProfit ProductGrossMarginPct i: ReturnedUnits f: ReturnRate ProductRefundAmount",
    "order_lines", f"""
SELECT BrandName, SUM(NetRevenue) AS ProductRevenue, SUM(GrossProfit) AS ProductGrossProfit, {div('SUM(GrossProfit)', 'SUM(NetRevenue)')} AS ProductGrossMarginPct,
       SUM(ReturnedQuantity) FILTER (live = 1) AS ReturnedUnits, {div('SUM(ReturnedQuantity) FILTER (live = 1)', 'SUM(Quantity) FILTER (live = 1)')} AS ReturnRate,
       SUM(RefundAmount) FILTER (live = 1) AS ProductRefundAmount FROM order_lines GROUP BY BrandName""",
    ["Product Revenue", "Product Gross Profit", "Product Gross Margin %", "Returned Units", "Return Rate", "Product Refund Amount"],
    [("DimProduct", "BrandName")],
)
measure_query(
    "x07_return_events", "s: YearMonth i: ReturnEventUnits f: ReturnRefundAmount", "b_returns return_items", """
SELECT strftime(ReturnDate, '%Y-%m') AS YearMonth, SUM(ReturnQuantity) AS ReturnEventUnits, SUM(RefundAmount) AS ReturnRefundAmount
FROM b_returns JOIN return_items USING (ReturnId) WHERE ReturnStatus <> 'Rejected' GROUP BY 1""",
    ["Return Event Units", "Return Refund Amount"], [("DimDate", "YearMonth")],
)
_DELIVERY = f"""
       NULLIF(COUNT(*) FILTER (DeliveredDate IS NOT NULL AND live = 1), 0) AS DeliveredOrders, NULLIF(COUNT(*) FILTER (IsOnTime = 1 AND live = 1), 0) AS OnTimeDeliveries,
       {div('COUNT(*) FILTER (IsOnTime = 1)', 'COUNT(DeliveredDate)')} AS OnTimeDeliveryPct, {div('SUM(DeliveryDays)', 'COUNT(DeliveryDays)')} AS AverageDeliveryDays,
       NULLIF(COUNT(*) FILTER (IsOnTime = 0), 0) AS LateDeliveries, {div('COUNT(*) FILTER (IsOnTime = 0)', 'COUNT(DeliveredDate)')} AS LateDeliveryPct"""
measure_query(
    "x08_delivery", "s: Carrier i: DeliveredOrders OnTimeDeliveries f: OnTimeDeliveryPct AverageDeliveryDays i: LateDeliveries f: LateDeliveryPct",
    "order_summary", f"SELECT Carrier, {_DELIVERY} FROM order_summary WHERE Carrier IS NOT NULL GROUP BY Carrier",
    ["Delivered Orders", "On-Time Deliveries", "On-Time Delivery %", "Average Delivery Days", "Late Deliveries", "Late Delivery %"],
    [("FactOrders", "Carrier")],
)
measure_query(
    "x09_reviews", "s: CategoryName i: Reviews f: AverageRating VerifiedReviewPct ReviewedItemReturnRate i: OneandTwoStarReviews f: LowRatingReviewPct",
    "reviews products refunds", f"""
SELECT CategoryName, COUNT(*) AS Reviews, {div('SUM(Rating)', 'COUNT(*)')} AS AverageRating, {div('SUM(IsVerifiedPurchase)', 'COUNT(*)')} AS VerifiedReviewPct,
       {div('NULLIF(SUM(returned), 0)', 'COUNT(*)')} AS ReviewedItemReturnRate, COUNT(*) FILTER (Rating <= 2) AS OneandTwoStarReviews,
       {div('COUNT(*) FILTER (Rating <= 2)', 'COUNT(*)')} AS LowRatingReviewPct
FROM (SELECT *, CAST(OrderItemId IN (SELECT OrderItemId FROM refunds) AS INTEGER) AS returned FROM reviews) JOIN products USING (ProductId) GROUP BY CategoryName""",
    ["Reviews", "Average Rating", "Verified Review %", "Reviewed Item Return Rate", "One and Two Star Reviews", "Low Rating Review %"],
    [("DimProduct", "CategoryName")],
)
_CAMPAIGN = f"""
       SUM(Audience) AS CampaignAudience, SUM(Clicks) AS CampaignClicks, SUM(Conversions) AS CampaignConversions, {div('SUM(Conversions)', 'SUM(Clicks)')} AS CampaignConversionPct,
       {div('SUM(Clicks)', 'SUM(Audience)')} AS CampaignCTRPct, SUM(AttributedRevenueAfterRefund) AS AttributedRevenue, SUM(AttributedGrossProfit) AS AttributedGrossProfit,
       SUM(AttributedOrders) AS AttributedOrders, {div('SUM(AttributedRevenueAfterRefund)', 'SUM(AttributedOrders)')} AS AttributedAverageOrderValue,
       SUM(DiscountCost) AS CampaignDiscountCost, {div('SUM(AttributedRevenueAfterRefund)', 'SUM(DiscountCost)')} AS AttributedRevenueperDiscountDollar,
       {div('SUM(AttributedGrossProfit)', 'SUM(Conversions)')} AS CampaignProfitperConversion"""
measure_query(
    "x10_campaigns",
    "s: PromotionType i: CampaignAudience CampaignClicks CampaignConversions f: CampaignConversionPct CampaignCTRPct AttributedRevenue AttributedGrossProfit"
    " i: AttributedOrders f: AttributedAverageOrderValue CampaignDiscountCost AttributedRevenueperDiscountDollar CampaignProfitperConversion",
    "campaign_performance", f"SELECT PromotionType, {_CAMPAIGN} FROM campaign_performance GROUP BY PromotionType",
    ["Campaign Audience", "Campaign Clicks", "Campaign Conversions", "Campaign Conversion %", "Campaign CTR %", "Attributed Revenue",
     "Attributed Gross Profit", "Attributed Orders", "Attributed Average Order Value", "Campaign Discount Cost",
     "Attributed Revenue per Discount Dollar", "Campaign Profit per Conversion"], [("DimPromotion", "PromotionType")],
)
query(
    "x11_retention", "d: CohortMonth i: MonthsSinceFirstOrder f: RetentionPct", "cohort_retention",
    "SELECT CohortMonth, MonthsSinceFirstOrder, RetentionRate AS RetentionPct FROM cohort_retention",
)(lambda t: tidy(measures.retention_percent(Star(t), ["CohortMonth", "MonthsSinceFirstOrder"])))
query(
    "x11b_retention_total", "d: CohortMonth f: RetentionPct", "cohort_retention",
    "SELECT CohortMonth, CASE WHEN COUNT(*) = 1 THEN MAX(RetentionRate) END AS RetentionPct FROM cohort_retention GROUP BY CohortMonth",
)(lambda t: tidy(measures.retention_percent(Star(t), ["CohortMonth"])))
query(
    "x12_rfm_share", "s: RfmSegment i: RFMCustomers f: RFMMonetaryValue RFMCustomerSharePct", "rfm", f"""
SELECT Segment AS RfmSegment, COUNT(*) AS RFMCustomers, SUM(MonetaryValue) AS RFMMonetaryValue, {div('COUNT(*)', '(SELECT COUNT(*) FROM rfm)')} AS RFMCustomerSharePct
FROM rfm GROUP BY Segment""",
)(lambda t: tidy(measures.rfm_share(Star(t))))

SERIES = "d: MonthStart f: Value PreviousMonth MoMChange MoMPct PreviousYear YoYChange YoYPct YearToDate Rolling3M Rolling12M"


def _series_sql(base: str, keys: str = "") -> str:
    """Shifted self-joins over a month grid that reaches one year past the data."""
    k = f"{keys}, " if keys else ""
    using = f"({keys}, MonthStart)" if keys else "(MonthStart)"
    return f"""
WITH base AS ({base}),
grid AS (SELECT {k}CAST(unnest(generate_series(CAST(MIN(MonthStart) AS TIMESTAMP), (SELECT MAX(FullDate) FROM calendar), INTERVAL 1 MONTH)) AS DATE) AS MonthStart
         FROM base {f'GROUP BY {keys}' if keys else ''}),
g AS (SELECT * FROM grid LEFT JOIN base USING {using}),
w AS (SELECT *, LAG(v) OVER o AS p, LAG(v, 12) OVER o AS y, SUM(v) OVER (PARTITION BY {k}year(MonthStart) ORDER BY MonthStart) AS ytd,
             SUM(v) OVER (o ROWS 2 PRECEDING) AS r3, SUM(v) OVER (o ROWS 11 PRECEDING) AS r12
      FROM g WINDOW o AS ({f'PARTITION BY {keys} ' if keys else ''}ORDER BY MonthStart))
{series_changes(k)}"""


def series_changes(k: str) -> str:
    """The columns of a series from w(MonthStart, v, p, y, ytd, r3, r12)."""
    return f"""
SELECT {k}MonthStart, v AS Value, p AS PreviousMonth, CASE WHEN v IS NOT NULL OR p IS NOT NULL THEN COALESCE(v, 0) - COALESCE(p, 0) END AS MoMChange,
       {D('COALESCE(v, 0) - COALESCE(p, 0)')} / NULLIF({D('p')}, 0) AS MoMPct, y AS PreviousYear,
       CASE WHEN v IS NOT NULL OR y IS NOT NULL THEN COALESCE(v, 0) - COALESCE(y, 0) END AS YoYChange,
       {D('COALESCE(v, 0) - COALESCE(y, 0)')} / NULLIF({D('y')}, 0) AS YoYPct, ytd AS YearToDate, r3 AS Rolling3M, r12 AS Rolling12M
FROM w WHERE v IS NOT NULL OR p IS NOT NULL OR y IS NOT NULL OR ytd IS NOT NULL OR r3 IS NOT NULL OR r12 IS NOT NULL"""


for _name, _measure, _sql in [
    ("x13_revenue_series", "Revenue", "SELECT MonthStart, SUM(NetRevenue) AS v FROM order_summary GROUP BY MonthStart"),
    ("x14a_orders_series", "Orders", "SELECT MonthStart, COUNT(*) AS v FROM valid_orders GROUP BY MonthStart"),
    ("x14b_gross_profit_series", "Gross Profit", "SELECT MonthStart, SUM(GrossProfit) AS v FROM order_summary GROUP BY MonthStart"),
]:
    query(_name, SERIES, "order_summary valid_orders calendar", _series_sql(_sql))(
        lambda t, m=_measure: measures.monthly_series(Star(t), m)
    )
query(
    "x15_to_date", "d: FullDate f: Value MonthToDate YearToDate", "order_summary calendar", """
SELECT FullDate, v AS Value, SUM(v) OVER (PARTITION BY year(FullDate), month(FullDate) ORDER BY FullDate) AS MonthToDate,
       SUM(v) OVER (PARTITION BY year(FullDate) ORDER BY FullDate) AS YearToDate
FROM calendar LEFT JOIN (SELECT OrderDate AS FullDate, SUM(RevenueAfterRefund) AS v FROM order_summary GROUP BY 1) USING (FullDate)
QUALIFY YearToDate IS NOT NULL""",
)(lambda t: measures.daily_to_date(Star(t), "Revenue After Refund").withColumnRenamed("Revenue After Refund", "Value"))
query(
    "x16_rolling_by_channel", "s: ChannelName " + SERIES, "order_summary calendar",
    _series_sql("SELECT ChannelName, MonthStart, SUM(NetRevenue) AS v FROM order_summary GROUP BY ALL", "ChannelName"),
)(lambda t: measures.monthly_series(Star(t), "Revenue", [CHANNEL]))
query(
    "x17_product_rank", "i: ProductId f: ProductRevenue i: ProductRevenueRank", "line_values", """
SELECT ProductId, SUM(NetRevenue) AS ProductRevenue, dense_rank() OVER (ORDER BY SUM(NetRevenue) DESC) AS ProductRevenueRank FROM line_values GROUP BY ProductId""",
)(lambda t: measures.product_revenue_rank(Star(t)))
query(
    "x18_customer_pareto", "i: CustomerId f: RevenueAfterRefund i: CustomerRevenueRank f: CumulativeCustomerRevenue ParetoRevenuePct i: ParetoFlag",
    "order_summary", f"""
WITH c AS (SELECT CustomerId, SUM(RevenueAfterRefund) AS v FROM order_summary GROUP BY CustomerId),
r AS (SELECT *, dense_rank() OVER (ORDER BY v DESC) AS k, row_number() OVER (ORDER BY v DESC, CustomerId) AS n,
             SUM(v) OVER (ORDER BY v DESC, CustomerId ROWS UNBOUNDED PRECEDING) AS running FROM c)
SELECT a.CustomerId, a.v AS RevenueAfterRefund, a.k AS CustomerRevenueRank, b.running AS CumulativeCustomerRevenue,
       {D('b.running')} / (SELECT {D('SUM(v)')} FROM c) AS ParetoRevenuePct, CAST({D('b.running')} / (SELECT {D('SUM(v)')} FROM c) <= 0.8 AS INTEGER) AS ParetoFlag
FROM r a JOIN r b ON b.n = a.k""",
)(lambda t: measures.customer_pareto(Star(t)))
measure_query(
    "x19_cancellations", "s: ChannelName i: CancelledOrders AllOrders f: CancellationRate", "order_summary", f"""
SELECT ChannelName, COUNT(*) FILTER (live = 0) AS CancelledOrders, COUNT(*) AS AllOrders, {div('COUNT(*) FILTER (live = 0)', 'COUNT(*)')} AS CancellationRate
FROM order_summary GROUP BY ChannelName""",
    ["Cancelled Orders", "All Orders", "Cancellation Rate"], [CHANNEL],
)
measure_query(
    "x20_promotion_orders", "s: Region i: PromotionOrders f: PromotionOrderRate", "valid_orders", f"""
SELECT Region, COUNT(PromotionId) AS PromotionOrders, {div('COUNT(PromotionId)', 'COUNT(*)')} AS PromotionOrderRate FROM valid_orders GROUP BY Region""",
    ["Promotion Orders", "Promotion Order Rate"], [REGION],
)


# ------------------------------------------------------------- report pages
def page(name, columns, needs, sql, build):
    query(name, columns, needs, sql)(lambda t: tidy(build(Star(t))))


_CARDS = f"""
SELECT SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfitAfterRefund) AS GrossProfitAfterRefund,
       {div('SUM(GrossProfitAfterRefund)', 'SUM(RevenueAfterRefund)')} AS GrossMarginAfterRefundPct, COUNT(*) FILTER (live = 1) AS Orders,
       COUNT(DISTINCT CustomerId) FILTER (live = 1) AS ActiveCustomers, {div('SUM(NetRevenue)', 'COUNT(*) FILTER (live = 1)')} AS AverageOrderValue
FROM order_summary"""
page(
    "x21a_executive_cards", "f: RevenueAfterRefund GrossProfitAfterRefund GrossMarginAfterRefundPct i: Orders ActiveCustomers f: AverageOrderValue",
    "order_summary", _CARDS + " WHERE OrderDate >= (SELECT date_trunc('month', MAX(OrderDate)) - INTERVAL 5 MONTH FROM order_summary)",
    lambda s: pages.executive_cards(s, [pages.latest_months(s)]),
)
page(
    "x21b_executive_channels", "s: ChannelName f: RevenueAfterRefund GrossProfitAfterRefund", "order_summary", """
SELECT ChannelName, SUM(RevenueAfterRefund) AS RevenueAfterRefund, SUM(GrossProfitAfterRefund) AS GrossProfitAfterRefund FROM order_summary GROUP BY 1""",
    pages.executive_by_channel,
)
page(
    "x21c_category_contribution", "s: CategoryName f: ProductRevenue ProductGrossProfit ProductGrossMarginPct ReturnRate", "order_lines", f"""
SELECT CategoryName, SUM(NetRevenue) AS ProductRevenue, SUM(GrossProfit) AS ProductGrossProfit, {div('SUM(GrossProfit)', 'SUM(NetRevenue)')} AS ProductGrossMarginPct,
       {div('SUM(ReturnedQuantity) FILTER (live = 1)', 'SUM(Quantity) FILTER (live = 1)')} AS ReturnRate FROM order_lines GROUP BY 1""",
    pages.category_contribution,
)
page(
    "x21d_exception_strip", "f: RefundRate ReturnRate LateDeliveryPct ChurnIndicatorPct", "order_summary line_values customer_metrics", f"""
SELECT {div('SUM(RefundAmount)', 'SUM(NetRevenue)')} AS RefundRate,
       (SELECT {div('SUM(ReturnedQuantity)', 'SUM(Quantity)')} FROM line_values WHERE live = 1) AS ReturnRate,
       {div('COUNT(*) FILTER (IsOnTime = 0)', 'COUNT(DeliveredDate)')} AS LateDeliveryPct,
       (SELECT {div("COUNT(*) FILTER (LifecycleStatus LIKE '%Risk')", 'COUNT(*) FILTER (LifetimeOrders > 0)')} FROM customer_metrics) AS ChurnIndicatorPct
FROM order_summary""",
    pages.exception_strip,
)
page(
    "x21e_revenue_trend", "d: MonthStart f: Value Rolling12M", "order_summary calendar",
    _series_sql("SELECT MonthStart, SUM(RevenueAfterRefund) AS v FROM order_summary GROUP BY MonthStart"), pages.revenue_trend,
)
page(
    "x21f_region_channel", "s: Region ChannelName f: RevenueAfterRefund GrossMarginAfterRefundPct i: Orders", "order_summary", f"""
SELECT Region, ChannelName, SUM(RevenueAfterRefund) AS RevenueAfterRefund, {div('SUM(GrossProfitAfterRefund)', 'SUM(RevenueAfterRefund)')} AS GrossMarginAfterRefundPct,
       COUNT(*) FILTER (live = 1) AS Orders FROM order_summary GROUP BY 1, 2""",
    pages.region_channel_matrix,
)
page(
    "x21g_channel_rank", "s: YearMonth ChannelName f: Revenue i: ChannelRank", "order_summary", f"""
SELECT *, rank() OVER (PARTITION BY YearMonth ORDER BY Revenue DESC) AS ChannelRank
FROM (SELECT {YM} AS YearMonth, ChannelName, SUM(NetRevenue) AS Revenue FROM order_summary GROUP BY ALL)""",
    pages.channel_rank_by_month,
)
page(
    "x21h_leakage_bridge", "i: Step s: Label f: Amount", "order_summary", """
SELECT 1 AS Step, 'Gross Revenue' AS Label, SUM(GrossRevenue) AS Amount FROM order_summary UNION ALL SELECT 2, 'Discount Amount', SUM(DiscountAmount) FROM order_summary
UNION ALL SELECT 3, 'Refund Amount', SUM(RefundAmount) FROM order_summary UNION ALL SELECT 4, 'Gross Profit After Refund', SUM(GrossProfitAfterRefund) FROM order_summary""",
    pages.leakage_bridge,
)
page(
    "x21i_daily_tail", "d: FullDate f: RevenueAfterRefund", "order_summary",
    "SELECT OrderDate AS FullDate, SUM(RevenueAfterRefund) AS RevenueAfterRefund FROM order_summary GROUP BY 1 ORDER BY 1 DESC LIMIT 30", pages.daily_tail,
)
page(
    "x21j_sales_detail", "s: ChannelName Region d: MonthStart f: Revenue MoMPct YoYPct i: Orders f: AverageOrderValue", "order_summary valid_orders calendar",
    "SELECT s.*, s.Value AS Revenue, Orders, AverageOrderValue FROM ("
    + _series_sql("SELECT ChannelName, Region, MonthStart, SUM(NetRevenue) AS v FROM order_summary GROUP BY ALL", "ChannelName, Region")
    + f""") s JOIN (SELECT ChannelName, Region, MonthStart, NULLIF(COUNT(*) FILTER (live = 1), 0) AS Orders,
       {div('SUM(NetRevenue)', 'COUNT(*) FILTER (live = 1)')} AS AverageOrderValue FROM order_summary GROUP BY ALL) USING (ChannelName, Region, MonthStart)
WHERE Orders IS NOT NULL""",
    pages.sales_detail,
)
page(
    "x21k_customer_cards", "i: ActiveCustomers RepeatCustomers f: AverageHistoricalCLV Projected12MCustomerValue RevenueatRisk", "valid_orders customer_metrics", f"""
SELECT COUNT(DISTINCT CustomerId) AS ActiveCustomers, COUNT(DISTINCT CustomerId) FILTER (IsRepeatPurchase = 1) AS RepeatCustomers,
       (SELECT {div('SUM(LifetimeRevenueAfterRefund)', 'COUNT(*)')} FROM customer_metrics WHERE LifetimeOrders > 0) AS AverageHistoricalCLV,
       (SELECT {div('SUM(Projected12MonthRevenue)', 'COUNT(*)')} FROM customer_metrics WHERE LifetimeOrders > 0) AS Projected12MCustomerValue,
       (SELECT SUM(LifetimeRevenueAfterRefund) FROM customer_metrics WHERE LifecycleStatus LIKE '%Risk') AS RevenueatRisk FROM valid_orders""",
    pages.customer_cards,
)
page(
    "x21l_risk_table", "i: CustomerId s: SegmentName LifecycleStatus i: RecencyDays LifetimeOrders f: LifetimeRevenueAfterRefund Projected12MonthRevenue",
    "customer_metrics", "SELECT * FROM customer_metrics WHERE LifecycleStatus LIKE '%Risk'", pages.risk_table,
)
_PRODUCT = f"""SUM(NetRevenue) AS ProductRevenue, SUM(GrossProfit) AS ProductGrossProfit, {div('SUM(GrossProfit)', 'SUM(NetRevenue)')} AS ProductGrossMarginPct,
       SUM(Quantity) FILTER (live = 1) AS UnitsSold, {div('SUM(ReturnedQuantity) FILTER (live = 1)', 'SUM(Quantity) FILTER (live = 1)')} AS ReturnRate"""
page(
    "x21m_top_products", "i: ProductId s: ProductName f: ProductRevenue ProductGrossProfit ProductGrossMarginPct i: UnitsSold f: ReturnRate AverageRating",
    "order_lines reviews", f"""
SELECT * FROM (SELECT ProductId, ProductName, {_PRODUCT} FROM order_lines GROUP BY 1, 2)
LEFT JOIN (SELECT ProductId, {div('SUM(Rating)', 'COUNT(*)')} AS AverageRating FROM reviews GROUP BY 1) USING (ProductId)
ORDER BY ProductRevenue DESC, ProductId LIMIT 15""",
    pages.top_products,
)
page(
    "x21n_category_matrix",
    "s: CategoryName SubcategoryName f: ProductRevenue ProductGrossProfit ProductGrossMarginPct i: UnitsSold f: ReturnRate AverageRating",
    "order_lines reviews products", f"""
SELECT * FROM (SELECT CategoryName, SubcategoryName, {_PRODUCT} FROM order_lines GROUP BY 1, 2)
LEFT JOIN (SELECT CategoryName, SubcategoryName, {div('SUM(Rating)', 'COUNT(*)')} AS AverageRating FROM reviews JOIN products USING (ProductId) GROUP BY 1, 2)
USING (CategoryName, SubcategoryName)""",
    pages.category_matrix,
)
page(
    "x21o_campaign_matrix",
    "s: PromotionName PromotionType i: CampaignAudience f: CampaignCTRPct CampaignConversionPct i: AttributedOrders f: AttributedRevenue AttributedGrossProfit"
    " CampaignProfitperConversion",
    "campaign_performance", f"SELECT PromotionName, PromotionType, {_CAMPAIGN} FROM campaign_performance GROUP BY 1, 2", pages.campaign_matrix,
)
page(
    "x21p_on_time_trend", "s: YearMonth f: OnTimeDeliveryPct", "order_summary", f"""
SELECT {YM} AS YearMonth, {div('NULLIF(COUNT(*) FILTER (IsOnTime = 1), 0)', 'COUNT(DeliveredDate)')} AS OnTimeDeliveryPct
FROM order_summary GROUP BY 1 HAVING OnTimeDeliveryPct IS NOT NULL""",
    pages.on_time_trend,
)
page(
    "x21q_carrier_region", "s: Carrier Region i: DeliveredOrders f: OnTimeDeliveryPct AverageDeliveryDays i: LateDeliveries", "order_summary",
    f"SELECT Carrier, Region, {_DELIVERY} FROM order_summary WHERE Carrier IS NOT NULL GROUP BY 1, 2", pages.carrier_region_sla,
)
page(
    "x21r_return_reasons", "s: ReturnReason f: ReturnRefundAmount i: ReturnEventUnits", "b_returns return_items", """
SELECT ReturnReason, SUM(RefundAmount) AS ReturnRefundAmount, SUM(ReturnQuantity) AS ReturnEventUnits
FROM b_returns JOIN return_items USING (ReturnId) WHERE ReturnStatus <> 'Rejected' GROUP BY 1""",
    pages.return_reasons,
)
page(
    "x21s_rating_behavior", "i: Rating Reviews f: ReviewedItemReturnRate", "reviews refunds", f"""
SELECT Rating, COUNT(*) AS Reviews, {div('NULLIF(COUNT(*) FILTER (OrderItemId IN (SELECT OrderItemId FROM refunds)), 0)', 'COUNT(*)')} AS ReviewedItemReturnRate
FROM reviews GROUP BY 1""",
    pages.rating_behavior,
)
page(
    "x21t_product_exceptions",
    "s: ProductName i: UnitsSold f: ProductRevenue ReturnRate ProductRefundAmount AverageRating LowRatingReviewPct", "order_lines reviews products", f"""
SELECT * FROM (SELECT ProductName, {_PRODUCT}, SUM(RefundAmount) FILTER (live = 1) AS ProductRefundAmount FROM order_lines GROUP BY 1)
LEFT JOIN (SELECT ProductName, {div('SUM(Rating)', 'COUNT(*)')} AS AverageRating, {div('NULLIF(COUNT(*) FILTER (Rating <= 2), 0)', 'COUNT(*)')} AS LowRatingReviewPct
           FROM reviews JOIN products USING (ProductId) GROUP BY 1) USING (ProductName) WHERE UnitsSold >= 100""",
    pages.product_exceptions,
)
