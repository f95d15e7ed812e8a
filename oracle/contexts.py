"""Measures that change their filter context, by name (x22), and distinct counts and ratios over several months (x14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.catalog import query
from oracle.star import CHANNEL, REGION, SERIES, D, div, series_changes, tidy
from orderwell.plans import measures
from orderwell.plans.contexts import Base, Shift, ToDate, Trailing
from orderwell.plans.star import Star

MONTH = ("DimDate", "YearMonth")


def asked(name, columns, needs, sql, names, group_by=(), filters=()):
    """Register a call of ``evaluate``; a filter's condition is SQL text, as there is no session yet."""

    def build(t):
        made = [(table, F.expr(condition), *column) for table, condition, *column in filters]
        return tidy(measures.evaluate(Star(t), names, group_by, made))

    query(name, columns, needs, sql)(build)


SAME, BEFORE, YEAR_AGO = "a.MonthStart = g.MonthStart", "a.MonthStart = g.MonthStart - INTERVAL 1 MONTH", "a.MonthStart = g.MonthStart - INTERVAL 12 MONTH"
TO_DATE = "year(a.MonthStart) = year(g.MonthStart) AND a.MonthStart <= g.MonthStart"
LAST_3 = "a.MonthStart BETWEEN g.MonthStart - INTERVAL 2 MONTH AND g.MonthStart"
LAST_12 = "a.MonthStart BETWEEN g.MonthStart - INTERVAL 11 MONTH AND g.MonthStart"


def months_met(keys: str = "") -> str:
    """Every month of the calendar (per key) beside the orders of that month and the twelve before it."""
    k = f"{keys}, " if keys else ""
    join = "".join(f"a.{c.strip()} = g.{c.strip()} AND " for c in keys.split(",") if c)
    grid = (
        f"SELECT {k}CAST(date_trunc('month', FullDate) AS DATE) AS MonthStart FROM calendar"
        + (f", (SELECT DISTINCT {keys} FROM order_summary)" if keys else "") + " GROUP BY ALL"
    )
    return f"({grid}) g JOIN order_summary a ON {join}a.MonthStart BETWEEN g.MonthStart - INTERVAL 24 MONTH AND g.MonthStart"


def over_months(value, keys: str = "") -> str:
    """A series from the orders themselves: `value` writes an aggregate under a condition on a (order) and g (month)."""
    k = "".join(f"g.{c.strip()}, " for c in keys.split(",") if c)
    columns = ", ".join(f"{value(c)} AS {n}" for n, c in zip(("v", "p", "y", "ytd", "r3", "r12"), (SAME, BEFORE, YEAR_AGO, TO_DATE, LAST_3, LAST_12)))
    return f"WITH w AS (SELECT {k}g.MonthStart, {columns} FROM {months_met(keys)} GROUP BY ALL) {series_changes(f'{keys}, ' if keys else '')}"


def total(column):
    return lambda where: f"SUM(a.{column}) FILTER ({where})"


def distinct(column, also="a.live = 1"):
    return lambda where: f"NULLIF(COUNT(DISTINCT a.{column}) FILTER ({where} AND {also}), 0)"


def share(top, bottom):
    return lambda where: f"({div(top(where), bottom(where))})"


ORDERS = distinct("OrderId")
CUSTOMERS = distinct("CustomerId")
REPEATING = distinct("CustomerId", "a.IsRepeatPurchase = 1")

for _name, _measure, _value, _groups in [
    ("x14c_active_customers_series", "Active Customers", CUSTOMERS, []),
    ("x14d_repeat_customers_by_channel", "Repeat Customers", REPEATING, [CHANNEL]),
    ("x14e_revenue_per_customer_by_region", "Revenue per Active Customer", share(total("RevenueAfterRefund"), CUSTOMERS), [REGION]),
    ("x14f_average_order_value_series", "Average Order Value", share(total("NetRevenue"), ORDERS), []),
]:
    _keys = ", ".join(c for _, c in _groups)
    query(_name, " ".join(["s:", *[c for _, c in _groups], SERIES]) if _groups else SERIES, "order_summary calendar", over_months(_value, _keys))(
        lambda t, m=_measure, g=_groups: measures.monthly_series(Star(t), m, g)
    )


# ------------------------------------------------ time intelligence by name
def growth(value, before):
    return f"{D(f'COALESCE({value}, 0) - COALESCE({before}, 0)')} / NULLIF({D(before)}, 0)"


_REVENUE, _KEPT, _PROFIT = total("NetRevenue"), total("RevenueAfterRefund"), total("GrossProfit")
asked(
    "x22a_time_measures",
    "s: ChannelName YearMonth f: RevenuePreviousMonth RevenueMoMChange RevenueMoMPct RevenuePreviousYear RevenueYoYChange RevenueYoYPct RevenueMTD"
    " RevenueYTD RevenueAfterRefundYTD Rolling3MRevenue Rolling12MRevenue i: OrdersPreviousYear f: OrdersYoYPct GrossProfitPreviousYear"
    " GrossProfitYoYPct i: ActiveCustomerPreviousYear f: ActiveCustomerYoYPct",
    "order_summary calendar", f"""
WITH w AS (
  SELECT g.ChannelName, g.MonthStart, {_REVENUE(SAME)} AS v, {_REVENUE(BEFORE)} AS p, {_REVENUE(YEAR_AGO)} AS y, {_REVENUE(TO_DATE)} AS ytd,
         {_KEPT(TO_DATE)} AS kept, {_REVENUE(LAST_3)} AS r3, {_REVENUE(LAST_12)} AS r12, {ORDERS(SAME)} AS o, {ORDERS(YEAR_AGO)} AS oy,
         {_PROFIT(SAME)} AS gp, {_PROFIT(YEAR_AGO)} AS gy, {CUSTOMERS(SAME)} AS c, {CUSTOMERS(YEAR_AGO)} AS cy
  FROM {months_met('ChannelName')} GROUP BY ALL)
SELECT ChannelName, strftime(MonthStart, '%Y-%m') AS YearMonth, p AS RevenuePreviousMonth,
       CASE WHEN v IS NOT NULL OR p IS NOT NULL THEN COALESCE(v, 0) - COALESCE(p, 0) END AS RevenueMoMChange, {growth('v', 'p')} AS RevenueMoMPct,
       y AS RevenuePreviousYear, CASE WHEN v IS NOT NULL OR y IS NOT NULL THEN COALESCE(v, 0) - COALESCE(y, 0) END AS RevenueYoYChange,
       {growth('v', 'y')} AS RevenueYoYPct, v AS RevenueMTD, ytd AS RevenueYTD, kept AS RevenueAfterRefundYTD, r3 AS Rolling3MRevenue,
       r12 AS Rolling12MRevenue, oy AS OrdersPreviousYear, {growth('o', 'oy')} AS OrdersYoYPct, gy AS GrossProfitPreviousYear,
       {growth('gp', 'gy')} AS GrossProfitYoYPct, cy AS ActiveCustomerPreviousYear, {growth('c', 'cy')} AS ActiveCustomerYoYPct
FROM w WHERE COALESCE(v, p, y, ytd, r3, r12) IS NOT NULL""",
    ["Revenue Previous Month", "Revenue MoM Change", "Revenue MoM %", "Revenue Previous Year", "Revenue YoY Change", "Revenue YoY %", "Revenue MTD",
     "Revenue YTD", "Revenue After Refund YTD", "Rolling 3M Revenue", "Rolling 12M Revenue", "Orders Previous Year", "Orders YoY %",
     "Gross Profit Previous Year", "Gross Profit YoY %", "Active Customer Previous Year", "Active Customer YoY %"],
    [CHANNEL, MONTH],
)

# quarters, the first and last of them cut by the date filter
_FROM, _TO = "1996-02-10", "1997-05-20"
_CUT = ("DimDate", f"FullDate BETWEEN DATE'{_FROM}' AND DATE'{_TO}'")


def _moved(months: int) -> str:
    back = f"CAST(FullDate - INTERVAL {months} MONTH AS DATE)"
    return f"""SELECT DISTINCT CalendarYear, CalendarQuarter, CAST(unnest(generate_series(CAST({back} AS TIMESTAMP),
        CASE WHEN FullDate = last_day(FullDate) THEN CAST(last_day({back}) AS TIMESTAMP) ELSE CAST({back} AS TIMESTAMP) END, INTERVAL 1 DAY)) AS DATE) AS OrderDate FROM cut"""


def _ended(first: str) -> str:
    return f"""SELECT CalendarYear, CalendarQuarter, CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS OrderDate
        FROM (SELECT CalendarYear, CalendarQuarter, MAX(FullDate) AS z FROM cut GROUP BY ALL)"""


_TRAIL = "CASE WHEN z = last_day(z) THEN date_trunc('month', z - INTERVAL 2 MONTH) ELSE z - INTERVAL 3 MONTH + INTERVAL 1 DAY END"
_CONTEXTS = [
    ("Revenue", "SELECT CalendarYear, CalendarQuarter, FullDate AS OrderDate FROM cut"), ("RevenuePreviousMonth", _moved(1)),
    ("RevenuePreviousYear", _moved(12)), ("RevenueMTD", _ended("date_trunc('month', z)")), ("RevenueYTD", _ended("date_trunc('year', z)")),
    ("Rolling3MRevenue", _ended(_TRAIL)),
]
asked(
    "x22b_partial_quarters", "i: CalendarYear CalendarQuarter f: " + " ".join(n for n, _ in _CONTEXTS), "order_summary calendar", f"""
WITH cut AS (SELECT * FROM calendar WHERE FullDate BETWEEN DATE '{_FROM}' AND DATE '{_TO}'),
met AS ({' UNION ALL '.join(f"SELECT '{n}' AS what, * FROM ({sql})" for n, sql in _CONTEXTS)})
SELECT CalendarYear, CalendarQuarter, {', '.join(f"SUM(NetRevenue) FILTER (what = '{n}') AS {n}" for n, _ in _CONTEXTS)}
FROM met JOIN order_summary USING (OrderDate) WHERE Region <> 'ASIA' GROUP BY ALL""",
    ["Revenue", "Revenue Previous Month", "Revenue Previous Year", "Revenue MTD", "Revenue YTD", "Rolling 3M Revenue"],
    [("DimDate", "CalendarYear"), ("DimDate", "CalendarQuarter")], [_CUT, ("DimGeography", "Region != 'ASIA'")],
)
asked(
    "x22c_new_customers", "s: SegmentName i: CalendarYear CalendarQuarter i: NewCustomers", "customer_metrics calendar", f"""
SELECT SegmentName, CalendarYear, CalendarQuarter, COUNT(*) AS NewCustomers
FROM customer_metrics JOIN calendar ON FullDate = FirstOrderDate
WHERE FullDate BETWEEN DATE '{_FROM}' AND DATE '{_TO}' AND SegmentName <> 'MACHINERY' GROUP BY ALL""",
    ["New Customers"], [("DimCustomer", "SegmentName"), ("DimDate", "CalendarYear"), ("DimDate", "CalendarQuarter")],
    [_CUT, ("DimCustomer", "SegmentName != 'MACHINERY'")],
)
asked(
    "x22d_rfm_share_of_all_segments", "s: SegmentName RfmSegment i: RFMCustomers f: RFMCustomerSharePct", "rfm customer_metrics", f"""
WITH r AS (SELECT SegmentName, Segment AS RfmSegment, CustomerId FROM rfm JOIN (SELECT CustomerId, SegmentName FROM customer_metrics) USING (CustomerId)),
n AS (SELECT SegmentName, COUNT(*) AS everyone FROM r GROUP BY ALL)
SELECT SegmentName, RfmSegment, COUNT(*) AS RFMCustomers, {div('COUNT(*)', 'any_value(everyone)')} AS RFMCustomerSharePct
FROM r JOIN n USING (SegmentName) WHERE RfmSegment IN ('Champions', 'At Risk') GROUP BY ALL""",
    ["RFM Customers", "RFM Customer Share %"], [("DimCustomer", "SegmentName"), ("FactRfmSnapshot", "RfmSegment")],
    [("FactRfmSnapshot", "RfmSegment IN ('Champions', 'At Risk')", "RfmSegment")],
)
asked(
    "x22e_product_rank_in_channel", "s: ChannelName i: ProductId f: ProductRevenue i: ProductRevenueRank", "line_values", """
SELECT ChannelName, ProductId, SUM(NetRevenue) AS ProductRevenue,
       dense_rank() OVER (PARTITION BY ChannelName ORDER BY SUM(NetRevenue) DESC) AS ProductRevenueRank
FROM line_values WHERE year(OrderDate) = 1997 GROUP BY ChannelName, ProductId""",
    ["Product Revenue", "Product Revenue Rank"], [CHANNEL, ("DimProduct", "ProductId")], [("DimDate", "CalendarYear = 1997")],
)
_PARETO = ["Customer Revenue Rank", "Cumulative Customer Revenue", "Pareto Revenue %", "Pareto 80% Customer Flag"]


def _pareto_sql(key: str) -> str:
    part, same = (f"PARTITION BY {key} ", f"a.{key} = b.{key} AND ") if key else ("", "")
    k, total_of = (f"{key}, ", f"(SELECT SUM(v) FROM c WHERE c.{key} = a.{key})") if key else ("", "(SELECT SUM(v) FROM c)")
    return f"""
WITH c AS (SELECT {k}CustomerId, SUM(RevenueAfterRefund) AS v FROM order_summary GROUP BY ALL),
r AS (SELECT *, dense_rank() OVER ({part}ORDER BY v DESC) AS k, row_number() OVER ({part}ORDER BY v DESC, CustomerId) AS n,
             SUM(v) OVER ({part}ORDER BY v DESC, CustomerId ROWS UNBOUNDED PRECEDING) AS running FROM c)
SELECT {f'a.{key}, ' if key else ''}a.CustomerId, a.k AS CustomerRevenueRank, b.running AS CumulativeCustomerRevenue,
       {D('b.running')} / {D(total_of)} AS ParetoRevenuePct, CAST({D('b.running')} / {D(total_of)} <= 0.8 AS INTEGER) AS Pareto80PctCustomerFlag
FROM r a JOIN r b ON {same}b.n = a.k"""


_PARETO_COLUMNS = "i: CustomerId CustomerRevenueRank f: CumulativeCustomerRevenue ParetoRevenuePct i: Pareto80PctCustomerFlag"
asked("x22f_customer_pareto", _PARETO_COLUMNS, "order_summary", _pareto_sql(""), _PARETO, [("DimCustomer", "CustomerId")])
asked(
    "x22g_customer_pareto_in_region", "s: Region " + _PARETO_COLUMNS, "order_summary", _pareto_sql("Region"), _PARETO,
    [REGION, ("FactOrders", "CustomerId")],
)
asked(
    "x22h_retention_of_late_cohorts", "d: CohortMonth i: MonthsSinceFirstOrder f: RetentionPct", "cohort_retention",
    "SELECT CohortMonth, MonthsSinceFirstOrder, RetentionRate AS RetentionPct FROM cohort_retention WHERE CohortMonth >= DATE '1993-01-01'",
    ["Retention %"], [("FactCohortRetention", "CohortMonth"), ("FactCohortRetention", "MonthsSinceFirstOrder")],
    [("FactCohortRetention", "CohortMonth >= DATE'1993-01-01'")],
)
asked(
    "x22i_nested_contexts", "s: YearMonth i: OrdersYTDYearAgo ActiveLast12M", "order_summary calendar", f"""
SELECT strftime(g.MonthStart, '%Y-%m') AS YearMonth,
       {ORDERS("year(a.MonthStart) = year(g.MonthStart) - 1 AND a.MonthStart <= g.MonthStart - INTERVAL 12 MONTH")} AS OrdersYTDYearAgo,
       {CUSTOMERS(LAST_12)} AS ActiveLast12M
FROM {months_met()} GROUP BY ALL HAVING COALESCE(OrdersYTDYearAgo, ActiveLast12M) IS NOT NULL""",
    [("Orders YTD Year Ago", Shift(ToDate(Base("Orders"), "year"), 12)), ("Active Last 12M", Trailing(Base("Active Customers"), 12))], [MONTH],
)
