"""Fixture cases, edge rows and the points where definitions could diverge."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderwell.operators import concentration, customers, facts, marketing, operations, products, sales
from shop import day, one, shop, when


def monthly_shop(spark):
    orders, items, people, places = [], [], [], []
    for i in range(14):
        date = f"{2024 + i // 12}-{i % 12 + 1:02d}-01"
        orders.append(dict(OrderId=i + 1, CustomerId=i + 1, ShippingAddressId=i + 1, OrderDate=when(date)))
        price = Decimal("100.00") if i < 12 else Decimal("200.00")
        items.append(dict(OrderItemId=i + 1, OrderId=i + 1, UnitPrice=price, UnitCost=price / 2))
        people.append(dict(CustomerId=i + 1))
        places.append(dict(AddressId=i + 1, CustomerId=i + 1))
    return shop(spark, orders=orders, order_items=items, customers=people, addresses=places)


def test_monthly_growth(spark):
    t = monthly_shop(spark)
    rows = sales.monthly_performance_fractions(t).orderBy("MonthStart").collect()
    assert rows[12]["RevenueYoYPct"] == pytest.approx(1.0)
    assert rows[13]["RevenueMoMPct"] == pytest.approx(0.0)
    assert rows[13]["RunningRevenue"] == 1600
    percent = sales.monthly_performance(t).orderBy("MonthStart").collect()
    assert percent[12]["RevenueYoYPct"] == pytest.approx(100.0)


def test_discount_effectiveness(spark):
    rows = [
        (1, day("2025-01-03"), "Web", None, 100, 100, 40, 0),
        (2, day("2025-01-18"), "Web", 7, 80, 75, 25, 20),
        (3, day("2025-02-02"), "Marketplace", None, 120, 120, 50, 0),
        (4, day("2025-02-14"), "Marketplace", 8, 90, 85, 30, 10),
    ]
    orders = spark.createDataFrame(
        rows,
        "OrderId int, OrderDate date, ChannelName string, PromotionId int, NetRevenue int,"
        " RevenueAfterRefund int, GrossProfit int, DiscountAmount int",
    )
    result = marketing.discount_effectiveness(orders)
    assert result.columns == [
        "MonthStart", "ChannelName", "PromotionGroup", "Orders", "AverageOrderValue",
        "RevenueAfterRefund", "GrossProfit", "DiscountCost", "GrossProfitPerOrder",
    ]
    got = result.collect()
    assert {r["PromotionGroup"] for r in got} == {"Promotion", "No Promotion"}
    assert {r["MonthStart"] for r in got} == {day("2025-01-01"), day("2025-02-01")}


def test_rfm_bounded_and_repeatable(spark):
    orders, items = [], []
    for i in range(20):
        date = dt.datetime(2025, 1, 1) + dt.timedelta(days=10 * i)
        orders.append(dict(OrderId=i + 1, CustomerId=i // 2 + 1, OrderDate=date))
        price = Decimal(50 + 450 * i) / 19 if i else Decimal(50)
        items.append(dict(OrderItemId=i + 1, OrderId=i + 1, UnitPrice=price.quantize(Decimal("0.01"))))
    t = shop(spark, orders=orders, order_items=items, customers=[dict(CustomerId=i) for i in range(1, 11)])
    for method in ("ntile", "percentile"):
        first = customers.rfm_snapshot(t, "2026-01-01", method).orderBy("CustomerId").collect()
        assert first == customers.rfm_snapshot(t, "2026-01-01", method).orderBy("CustomerId").collect()
        assert len(first) == 10
        for r in first:
            assert all(1 <= r[c] <= 5 for c in ("RScore", "FScore", "MScore"))
            assert r["Segment"] and r["RfmCode"] == f"{r['RScore']}{r['FScore']}{r['MScore']}"


def test_quintile_methods_differ_on_leftovers(spark):
    rows = [(day("2025-01-01"), i, i, i, Decimal(i)) for i in range(1, 8)]
    base = spark.createDataFrame(
        rows, "SnapshotDate date, CustomerId long, RecencyDays int, Frequency long, MonetaryValue decimal(18,2)"
    )

    def scores(method):
        return [r["FScore"] for r in customers.score_rfm(base, method).orderBy("CustomerId").collect()]

    assert scores("ntile") == [1, 1, 2, 2, 3, 4, 5]
    assert scores("percentile") == [1, 2, 3, 3, 4, 5, 5]
    with pytest.raises(ValueError):
        customers.score_rfm(base, "other")


@pytest.fixture(scope="module")
def edge(spark):
    """Cancelled order between two valid ones, returns of all kinds, an order without lines."""
    return shop(
        spark,
        customers=[dict(CustomerId=1), dict(CustomerId=2, AcquisitionSource="Email")],
        orders=[
            dict(OrderId=1, OrderDate=when("2024-01-10")),
            dict(OrderId=2, OrderDate=when("2024-01-20"), StatusId=5),
            dict(OrderId=3, OrderDate=when("2024-03-31T23:59:59"), PromotionId=1, PromoCode="P1"),
            dict(OrderId=4, OrderDate=when("2024-04-05"), StatusId=2),
        ],
        order_items=[
            dict(OrderItemId=1, OrderId=1, Quantity=2, DiscountAmount=Decimal("1.00")),
            dict(OrderItemId=2, OrderId=1, ProductId=2),
            dict(OrderItemId=3, OrderId=2),
            dict(OrderItemId=4, OrderId=3, UnitPrice=Decimal("0.00"), UnitCost=Decimal("0.00")),
        ],
        shipments=[
            dict(ShipmentId=1, OrderId=1, ShippedDate=when("2024-01-11"),
                 PromisedDeliveryDate=day("2024-01-15"), DeliveredDate=when("2024-01-15T18:00:00")),
            dict(ShipmentId=3, OrderId=3, PromisedDeliveryDate=day("2024-04-04")),
        ],
        returns=[
            dict(ReturnId=1, OrderId=1), dict(ReturnId=2, OrderId=1),
            dict(ReturnId=3, OrderId=1, ReturnStatus="Rejected"), dict(ReturnId=4, OrderId=2),
        ],
        return_items=[
            dict(ReturnItemId=1, ReturnId=1, OrderItemId=1), dict(ReturnItemId=2, ReturnId=2, OrderItemId=1),
            dict(ReturnItemId=3, ReturnId=3, OrderItemId=2), dict(ReturnItemId=4, ReturnId=4, OrderItemId=3),
        ],
        product_reviews=[
            dict(ReviewId=1, OrderItemId=2, ProductId=2, Rating=1), dict(ReviewId=2, OrderItemId=1),
        ],
    )


def test_cancelled_order_keeps_row_without_value(edge):
    row = one(facts.order_summary(edge), OrderId=2)
    assert (row["GrossRevenue"], row["NetRevenue"], row["GrossProfit"]) == (10, 0, 0)
    # Its refund stays visible and does not touch after-refund revenue.
    assert (row["RefundAmount"], row["RevenueAfterRefund"]) == (1, 0)
    assert (row["CustomerOrderNumber"], row["IsRepeatPurchase"]) == (1, 0)


def test_sequence_skips_cancelled_and_order_without_lines_is_absent(edge):
    summary = facts.order_summary(edge)
    assert {r["OrderId"] for r in summary.collect()} == {1, 2, 3}
    assert one(summary, OrderId=3)["CustomerOrderNumber"] == 2
    assert one(summary, OrderId=3)["IsRepeatPurchase"] == 1
    fast = facts.order_facts(edge, repeat=True)
    assert {(r["OrderId"], r["IsRepeatPurchase"]) for r in fast.collect()} == {(1, 0), (2, 0), (3, 1)}


def test_returns_do_not_fan_out_and_rejected_ones_do_not_count(edge):
    row = one(facts.order_summary(edge), OrderId=1)
    assert (row["Units"], row["NetRevenue"], row["ReturnedUnits"], row["RefundAmount"]) == (3, 29, 2, 2)
    assert (row["RevenueAfterRefund"], row["GrossProfitAfterRefund"]) == (27, 15)
    lines = facts.order_lines(edge)
    assert one(lines, OrderItemId=1)["ReturnedQuantity"] == 2
    assert one(lines, OrderItemId=2)["ReturnedQuantity"] == 0


def test_delivery_flags(edge):
    done, open_ = one(facts.order_summary(edge), OrderId=1), one(facts.order_summary(edge), OrderId=3)
    assert (done["DeliveryDays"], done["IsOnTime"]) == (5, 1)
    assert (open_["DeliveryDays"], open_["IsOnTime"]) == (None, None)


def test_zero_denominator_is_null(edge):
    assert one(facts.order_lines(edge), OrderItemId=4)["DiscountRate"] is None


def test_empty_month_is_kept(edge):
    rows = {r["YearMonth"]: r for r in sales.monthly_kpis(edge).collect()}
    # The spine reaches April, whose only order has no lines.
    assert sorted(rows) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert (rows["2024-02"]["Orders"], rows["2024-02"]["NetRevenue"], rows["2024-02"]["AverageOrderValue"]) == (0, 0, 0)
    present = sales.sales_performance(edge, "2024-01-01", "2024-12-31").collect()
    assert [r["MonthStart"] for r in present] == [day("2024-01-01"), day("2024-03-01")]


def test_end_date_is_inclusive(edge):
    assert sales.sales_performance(edge, "2024-03-31", "2024-03-31").first()["Orders"] == 1
    assert sales.sales_performance(edge, "2024-03-01", "2024-03-30").count() == 0


def test_returned_flag_has_two_definitions(edge):
    by_any = {r["ReviewId"]: r["WasReturned"] for r in operations.review_facts(edge).collect()}
    accepted = {r["ReviewId"]: r["WasReturned"] for r in operations.review_facts(edge, count_rejected=False).collect()}
    assert by_any == {1: 1, 2: 1} and accepted == {1: 0, 2: 1}


def test_product_without_reviews_has_no_rating(spark):
    t = shop(spark, orders=[dict(OrderId=1, OrderDate=when("2024-01-01"))], order_items=[dict(OrderItemId=1, OrderId=1)])
    row = products.product_performance(t).first()
    assert (row["Reviews"], row["AverageRating"]) == (0, None)


def test_promotion_and_source_without_activity_stay(edge):
    promo = marketing.campaign_performance(edge).first()
    assert (promo["Audience"], promo["Clicks"], promo["AttributedOrders"]) == (0, 0, 1)
    assert promo["ClickThroughRate"] is None and promo["ClickToConversionRate"] is None
    source = one(marketing.acquisition_performance(edge), AcquisitionSource="Email")
    assert (source["Customers"], source["Orders"], source["AcquiredCustomers"]) == (0, 0, 1)
    assert source["PurchaserConversionRate"] == 0 and source["RevenuePerPurchaser"] is None


@pytest.mark.parametrize(
    "orders, recency, gap, status",
    [
        (0, None, None, "Prospect"),
        (1, 90, None, "Active"), (1, 91, None, "One-Time Lapsed"),
        (2, 90, 10.0, "At Risk"), (2, 91, 10.0, "High Risk"),
        (2, 60, 10.0, "Active"), (2, 61, 10.0, "At Risk"),
        (3, 200, 100.0, "At Risk"), (3, 201, 100.0, "High Risk"), (3, 150, 100.0, "Active"),
        (2, 67, None, "Active"), (2, 68, None, "At Risk"), (2, 91, None, "High Risk"),
    ],
)
def test_lifecycle_limits(spark, orders, recency, gap, status):
    row = spark.createDataFrame([(orders, recency, gap)], "o int, r int, g double")
    got = row.select(customers.lifecycle_status(F.col("o"), F.col("r"), F.col("g"))).first()[0]
    assert got == status


def test_customer_metrics(edge):
    buyer, prospect = (one(customers.customer_metrics(edge), CustomerId=c) for c in (1, 2))
    # As of the day after the last order of any status.
    assert buyer["AsOfDate"] == day("2024-04-06")
    assert (buyer["LifetimeOrders"], buyer["LifetimeRevenue"], buyer["AvgDaysBetweenOrders"]) == (2, 29, 81.0)
    assert buyer["RecencyDays"] == 6
    days = (day("2024-04-06") - day("2023-01-01")).days
    assert float(buyer["Projected12MonthRevenue"]) == pytest.approx(27 / (days / 365.25), abs=0.005)
    assert (prospect["LifecycleStatus"], prospect["LifetimeOrders"], prospect["Projected12MonthRevenue"]) == ("Prospect", 0, 0)
    assert prospect["RecencyDays"] is None


def test_short_tenure_counts_as_ninety_days(spark):
    row = spark.range(1).select(customers.annual_run_rate(F.lit(Decimal("100.00")), F.lit(5))).first()[0]
    assert float(row) == pytest.approx(100 * 365.25 / 90, abs=0.005)


def test_repeat_timing(edge):
    row = customers.repeat_timing(edge).first()
    assert (row["FirstTimeCustomers"], row["RepeatedWithin60Days"], row["RepeatedWithin90Days"]) == (1, 0, 1)
    assert row["AvgDaysToSecondOrder"] == 81.0


def test_pareto_cut_with_equal_values(spark):
    """Four equal customers: the first row at or past 80 percent is the fourth."""
    ids = range(1, 5)
    t = shop(
        spark,
        customers=[dict(CustomerId=i) for i in ids],
        orders=[dict(OrderId=i, CustomerId=i, OrderDate=when("2024-01-01")) for i in ids],
        order_items=[dict(OrderItemId=i, OrderId=i) for i in ids],
    )
    row = concentration.pareto_threshold(t).first()
    assert (row["CustomersRequired"], row["RevenueShareReached"]) == (4, 1.0)
    from orderwell.plans.measures import customer_pareto
    from orderwell.plans.star import Star

    flags = customer_pareto(Star(t)).collect()
    # The dense rank is 1 for all, so each covers one customer's revenue only.
    assert {(r["CustomerRevenueRank"], float(r["CumulativeCustomerRevenue"]), r["ParetoFlag"]) for r in flags} == {(1, 10.0, 1)}


def test_customer_360_unknown_customer(edge):
    with pytest.raises(ValueError):
        customers.customer_360(edge, 99)
    views = customers.customer_360(edge, 1)
    assert [r["OrderId"] for r in views["orders"].collect()] == [3, 2, 1]
    assert [r["PreferenceRank"] for r in views["products"].collect()] == [1, 2]


@pytest.mark.parametrize(
    "call",
    [
        lambda t: sales.sales_performance(t, "2024-02-01", "2024-01-01"),
        lambda t: sales.sales_performance(t, None, "2024-01-01"),
        lambda t: sales.sales_performance(t, "2024-01-01", "9999-12-31"),
        lambda t: sales.sales_performance(t, "2024-01-01", "2024-02-01", channel="Nope"),
        lambda t: sales.sales_performance(t, "2024-01-01", "2024-02-01", region="Nope"),
        lambda t: customers.rfm_snapshot(t, "9999-12-31"),
        lambda t: customers.cohort_retention_range(t, "2024-02-01", "2024-01-01"),
        lambda t: customers.cohort_retention_range(t, "2024-01-01", "2024-02-01", 37),
        lambda t: products.product_ranking(t, min_orders=0),
        lambda t: products.product_ranking(t, top_n=501),
    ],
)
def test_arguments_are_checked(edge, call):
    with pytest.raises(ValueError):
        call(edge)


def test_affinity_arguments(edge):
    from orderwell.operators.basket import product_affinity

    for bad in (dict(min_pair_orders=1), dict(top_n=0), dict(top_n=501)):
        with pytest.raises(ValueError):
            product_affinity(edge, "2024-01-01", "2024-02-01", **bad)


def test_unique_check(edge):
    assert facts.assert_unique(edge["orders"], "OrderId").count() == 0
    assert facts.assert_unique(edge["orders"], "CustomerId").first()["Copies"] == 4
