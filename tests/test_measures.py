"""Measure layer: names, filter reach, blanks and calendar shifts."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderwell.plans import contexts, measures
from orderwell.plans.measures import BASE, RATIOS, evaluate, monthly_series, retention_percent
from orderwell.plans.star import Star
from shop import day, shop, when


@pytest.fixture(scope="module")
def star(spark):
    dates = {1: "2023-02-10", 2: "2024-01-10", 3: "2024-02-10", 4: "2024-04-10"}
    return Star(
        shop(
            spark,
            orders=[dict(OrderId=i, OrderDate=when(d), ChannelId=1 + i % 2) for i, d in dates.items()],
            order_items=[
                dict(OrderItemId=i, OrderId=i, UnitPrice=Decimal(10 * i)) for i in dates
            ],
        )
    )


# The names of all measures, by what they can be grouped by here.
BY_MONTH = [
    "Revenue", "Revenue After Refund", "Gross Revenue", "Discount Amount", "Refund Amount", "Gross Profit",
    "Gross Profit After Refund", "Gross Margin %", "Gross Margin After Refund %", "Discount Rate", "Refund Rate",
    "Orders", "Units Sold", "Active Customers", "New Customers", "Repeat Orders", "Repeat Customers",
    "Repeat Order Rate", "Average Order Value", "Revenue per Active Customer",
    "Product Revenue", "Product Gross Profit", "Product Gross Margin %", "Returned Units", "Return Rate",
    "Return Event Units", "Return Refund Amount", "Product Refund Amount",
    "Delivered Orders", "On-Time Deliveries", "On-Time Delivery %", "Average Delivery Days",
    "Reviews", "Average Rating", "Verified Review %", "Reviewed Item Return Rate",
    "Campaign Audience", "Campaign Clicks", "Campaign Conversions", "Campaign Conversion %", "Campaign CTR %",
    "Attributed Revenue", "Attributed Gross Profit", "Campaign Discount Cost", "Attributed Revenue per Discount Dollar",
    "RFM Customers", "RFM Monetary Value",
    "Revenue Previous Month", "Revenue MoM Change", "Revenue MoM %", "Revenue Previous Year", "Revenue YoY Change",
    "Revenue YoY %", "Revenue MTD", "Revenue YTD", "Revenue After Refund YTD", "Rolling 3M Revenue", "Rolling 12M Revenue",
    "Cancelled Orders", "All Orders", "Cancellation Rate", "Late Deliveries", "Late Delivery %", "Attributed Orders",
    "Attributed Average Order Value", "Campaign Profit per Conversion", "Promotion Orders", "Promotion Order Rate",
    "One and Two Star Reviews", "Low Rating Review %", "Orders Previous Year", "Orders YoY %",
    "Gross Profit Previous Year", "Gross Profit YoY %", "Active Customer Previous Year", "Active Customer YoY %",
    "RFM Customer Share %",
]
BY_CUSTOMER = [
    "Customer Revenue Rank", "Cumulative Customer Revenue", "Pareto Revenue %", "Pareto 80% Customer Flag",
    "Average Historical CLV", "Projected 12M Customer Value", "Customers at Risk", "Churn Indicator %", "Revenue at Risk",
]
BY_PRODUCT = ["Product Revenue Rank"]
BY_COHORT = ["Retention %"]


def test_all_measures_by_name_with_groups_and_filters(star):
    assert len({*BY_MONTH, *BY_CUSTOMER, *BY_PRODUCT, *BY_COHORT}) == 88
    for top, bottom in RATIOS.values():
        assert top in BASE and bottom in BASE
    dates = ("DimDate", F.col("FullDate") >= "2024-02-01")
    for names, group, condition in [
        (BY_MONTH, ("DimDate", "YearMonth"), dates),
        (BY_CUSTOMER, ("DimCustomer", "CustomerId"), ("DimCustomer", F.col("CustomerId") > 0)),
        (BY_PRODUCT, ("DimProduct", "ProductId"), dates),
        (BY_COHORT, ("FactCohortRetention", "CohortMonth"), ("FactCohortRetention", F.col("MonthsSinceFirstOrder") == 0)),
    ]:
        result = evaluate(star, names, [group], [condition])
        assert result.columns == [group[1], *names]
        assert result.collect(), names
    months = evaluate(star, ["Revenue", "Revenue YTD", "Rolling 3M Revenue", "Revenue Previous Year", "New Customers"], [("DimDate", "YearMonth")], [dates])
    rows = {r["YearMonth"]: r for r in months.collect()}
    # the filter cuts the cells; a moved context reaches behind it, a context to date ends in its cell
    assert [rows["2024-02"][c] for c in ("Revenue", "Revenue YTD", "Rolling 3M Revenue", "Revenue Previous Year", "New Customers")] == [30, 50, 50, 10, None]
    assert (rows["2024-03"]["Revenue"], rows["2024-03"]["Revenue YTD"]) == (None, 50)


def test_a_rank_needs_its_members(star):
    with pytest.raises(ValueError, match="not among the groups"):
        evaluate(star, ["Product Revenue Rank"], [("DimChannel", "ChannelName")])


def test_contexts_of_dates(spark):
    def days(first, last):
        return spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS FullDate")

    def bounds(change, first, last):
        row = contexts.cell_dates(days(first, last), [], [change]).agg(F.min("FullDate"), F.max("FullDate"), F.count("*")).first()
        return str(row[0]), str(row[1]), row[2]

    any_base = contexts.Base("Revenue")
    back, year, trail = contexts.Shift(any_base, 1), contexts.Shift(any_base, 12), contexts.Trailing(any_base, 3)
    # whole months move to whole months, whatever their length; other days keep their number
    assert bounds(back, "2024-02-01", "2024-02-29") == ("2024-01-01", "2024-01-31", 31)
    assert bounds(back, "2024-03-01", "2024-03-31") == ("2024-02-01", "2024-02-29", 29)
    assert bounds(back, "2024-03-10", "2024-03-20") == ("2024-02-10", "2024-02-20", 11)
    assert bounds(year, "2024-02-29", "2024-02-29") == ("2023-02-28", "2023-02-28", 1)
    assert bounds(year, "2025-02-28", "2025-02-28") == ("2024-02-28", "2024-02-29", 2)
    assert bounds(trail, "2024-04-10", "2024-04-30") == ("2024-02-01", "2024-04-30", 90)
    assert bounds(trail, "2024-04-10", "2024-04-20") == ("2024-01-21", "2024-04-20", 91)
    assert bounds(contexts.ToDate(any_base, "year"), "2024-04-10", "2024-04-20") == ("2024-01-01", "2024-04-20", 111)
    assert bounds(contexts.ToDate(any_base, "month"), "2024-03-10", "2024-04-20") == ("2024-04-01", "2024-04-20", 20)
    assert contexts.cell_dates(days("2024-01-01", "2024-01-02").where("false"), [], [trail]).count() == 0


def test_changes_of_context_reach_the_leaves():
    made = contexts.lowered(contexts.Shift(contexts.Ratio(contexts.Base("a"), contexts.ToDate(contexts.Base("b"), "year")), 12))
    a, b = contexts.leaves(made)
    assert (a.base, [type(c).__name__ for c in a.changes]) == ("a", ["Shift"])
    assert (b.base, [type(c).__name__ for c in b.changes]) == ("b", ["Shift", "ToDate"])


def test_distinct_counts_over_months_count_an_item_once(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), rng.randint(1, 6), rng.randint(2020 * 12 + 1, 2022 * 12 + 12)) for _ in range(90)]
    orders = spark.createDataFrame(
        [(i, c, f"{(m - 1) // 12}-{(m - 1) % 12 + 1:02d}-15", 10000 * ((m - 1) // 12) + 100 * ((m - 1) % 12 + 1) + 15, "Delivered", g) for i, (g, c, m) in enumerate(rows)],
        "OrderId long, CustomerId long, OrderDate string, OrderDateKey int, StatusName string, Carrier string",
    ).withColumn("OrderDate", F.to_date("OrderDate"))
    calendar = spark.sql(
        "SELECT FullDate, year(FullDate) * 10000 + month(FullDate) * 100 + day(FullDate) AS DateKey, date_format(FullDate, 'yyyy-MM') AS YearMonth"
        " FROM (SELECT explode(sequence(DATE'2020-01-01', DATE'2023-12-31')) AS FullDate)"
    )
    found = monthly_series({"FactOrders": orders, "DimDate": calendar}, "Active Customers", [("FactOrders", "Carrier")])
    got = {(r["Carrier"], r["MonthStart"].year * 12 + r["MonthStart"].month): r for r in found.collect()}

    def count(group, low, high):
        return len({c for g, c, m in rows if g == group and low <= m <= high}) or None

    for group in "ab":
        for m in range(2020 * 12 + 1, 2023 * 12 + 13):
            want = [count(group, m, m), count(group, m - 1, m - 1), count(group, m - 12, m - 12),
                    count(group, (m - 1) // 12 * 12 + 1, m), count(group, m - 2, m), count(group, m - 11, m)]
            row = got.get((group, m))
            assert [row[c] for c in measures.PERIODS] == want if row else want == [None] * 6, (group, m)


def test_calendar_shifts(star):
    rows = {r["MonthStart"]: r for r in monthly_series(star, "Revenue").collect()}
    feb = rows[day("2024-02-01")]
    assert (feb["Value"], feb["PreviousMonth"], feb["PreviousYear"]) == (30, 20, 10)
    assert (feb["MoMPct"], feb["YoYPct"], feb["YearToDate"], feb["Rolling3M"]) == (0.5, 2.0, 50, 50)
    # March sold nothing: its own value is blank, not zero, but the past is there.
    march = rows[day("2024-03-01")]
    assert (march["Value"], march["PreviousMonth"], march["MoMChange"], march["MoMPct"]) == (None, 30, -30, -1.0)
    april = rows[day("2024-04-01")]
    assert (april["PreviousMonth"], april["MoMChange"], april["MoMPct"], april["Rolling3M"]) == (None, 40, None, 70)


def test_filters_reach_related_facts_only(star):
    only = [("DimChannel", F.col("ChannelName") == "Website")]
    row = evaluate(star, ["Orders", "Units Sold", "Customers at Risk"], filters=only).first()
    assert (row["Orders"], row["Units Sold"]) == (2, 2)
    alone = evaluate(star, ["Customers at Risk"]).collect()
    assert row["Customers at Risk"] == (alone[0][0] if alone else None)


def test_unknown_measure_and_unrelated_dimension(star):
    with pytest.raises(ValueError):
        evaluate(star, ["Nope"])
    with pytest.raises(ValueError):
        evaluate(star, ["Reviews"], [("DimChannel", "ChannelName")])


def test_blank_rows_are_left_out(star):
    assert evaluate(star, ["Cancelled Orders"], [("DimChannel", "ChannelName")]).count() == 0


def test_retention_needs_one_cell(star):
    totals = retention_percent(star, ["CohortMonth"]).collect()
    assert [r["Retention %"] for r in totals] == [None]
    cells = retention_percent(star, ["CohortMonth", "MonthsSinceFirstOrder"]).collect()
    assert {r["Retention %"] for r in cells} == {1.0}


def test_new_customers_by_period(star):
    rows = measures.new_customers(star).collect()
    assert [(r["YearMonth"], r["New Customers"]) for r in rows] == [("2023-02", 1)]
