"""Monthly, annual, channel and regional sales."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import date_key, month_start, ratio, sum_money, zero_if_null
from orderwell.functions.scalars import growth_pct
from orderwell.operators.facts import Tables, valid_orders
from orderwell.operators.validation import date_range, in_range, must_exist


def month_spine(t: Tables) -> DataFrame:
    """Every month from the first to the last order of any status."""
    bounds = t["orders"].agg(
        F.min("OrderDate").cast("date").alias("lo"), F.max("OrderDate").cast("date").alias("hi")
    )
    months = bounds.select(
        F.explode(
            F.sequence(month_start("lo"), month_start("hi"), F.expr("INTERVAL 1 MONTH"))
        ).alias("MonthStart")
    )
    day = F.col("MonthStart")
    return months.select(
        date_key(day).alias("DateKey"),
        day,
        F.year(day).alias("CalendarYear"),
        F.quarter(day).alias("CalendarQuarter"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.date_format(day, "yyyy-MM").alias("YearMonth"),
    )


def _customer_months(orders: DataFrame, *keys: str) -> DataFrame:
    """Orders summed to customer and month (and ``keys``).

    Counting these rows is the distinct customer count, so the exact distinct
    needs no second pass over the orders.
    """
    return orders.groupBy("CustomerId", *keys).agg(
        F.count(F.lit(1)).alias("Orders"),
        F.sum("IsRepeatPurchase").alias("RepeatOrders"),
        sum_money("NetRevenue").alias("NetRevenue"),
        sum_money("RevenueAfterRefund").alias("RevenueAfterRefund"),
        sum_money("GrossProfit").alias("GrossProfit"),
        sum_money("DiscountAmount").alias("Discounts"),
        F.sum("ReturnedUnits").alias("ReturnedUnits"),
    )


def _totals(per_customer: DataFrame, *keys: str) -> DataFrame:
    sums = [
        "Orders", "RepeatOrders", "NetRevenue", "RevenueAfterRefund", "GrossProfit", "Discounts",
        "ReturnedUnits",
    ]
    return per_customer.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ActiveCustomers"), *[F.sum(c).alias(c) for c in sums]
    )


def monthly_kpis(t: Tables) -> DataFrame:
    """Grain: calendar month, months without orders included."""
    orders = valid_orders(t, repeat=True)
    totals = _totals(_customer_months(orders, "MonthStart"), "MonthStart")
    measures = [c for c in totals.columns if c != "MonthStart"]
    return (
        month_spine(t)
        .join(totals, "MonthStart", "left")
        .withColumns({c: zero_if_null(c) for c in measures})
        .withColumn(
            "AverageOrderValue", F.coalesce(ratio("NetRevenue", "Orders"), F.lit(0.0))
        )
    )


def _by_month() -> Window:
    # One row per month: a few hundred rows whatever the data size.
    return Window.partitionBy(F.lit(0)).orderBy("MonthStart")


def _rolling_mean(column: str, months: int):
    frame = _by_month().rowsBetween(1 - months, 0)
    return ratio(F.sum(column).over(frame), F.count(column).over(frame))


def with_comparisons(monthly: DataFrame) -> DataFrame:
    """Previous month and year, rolling means and running total over month rows."""
    months = _by_month()
    return monthly.withColumns(
        {
            "PreviousMonthRevenue": F.lag("NetRevenue", 1).over(months),
            "PreviousYearRevenue": F.lag("NetRevenue", 12).over(months),
            "PreviousMonthGrossProfit": F.lag("GrossProfit", 1).over(months),
            "Rolling3MonthRevenue": _rolling_mean("NetRevenue", 3),
            "Rolling12MonthRevenue": _rolling_mean("NetRevenue", 12),
            "RunningRevenue": F.sum("NetRevenue").over(
                months.rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )


def with_growth(compared: DataFrame) -> DataFrame:
    return compared.withColumns(
        {
            "RevenueMoMPct": growth_pct("NetRevenue", "PreviousMonthRevenue"),
            "RevenueYoYPct": growth_pct("NetRevenue", "PreviousYearRevenue"),
            "GrossProfitMoMPct": growth_pct("GrossProfit", "PreviousMonthGrossProfit"),
        }
    )


def monthly_performance(t: Tables) -> DataFrame:
    """Grain: calendar month with comparisons.  Growth is in percent."""
    return with_growth(with_comparisons(monthly_kpis(t)))


def monthly_performance_fractions(t: Tables) -> DataFrame:
    """The same months in the notebook's units: growth as a fraction, plus rates."""
    monthly = with_comparisons(monthly_kpis(t))
    one = F.lit(1.0)
    return monthly.withColumns(
        {
            "RevenueMoMPct": ratio("NetRevenue", "PreviousMonthRevenue") - one,
            "RevenueYoYPct": ratio("NetRevenue", "PreviousYearRevenue") - one,
            "GrossMarginRate": ratio("GrossProfit", "NetRevenue"),
            "RepeatOrderRate": ratio("RepeatOrders", "Orders"),
        }
    )


def sales_performance(
    t: Tables,
    start: dt.date | str,
    end: dt.date | str,
    channel: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """Months inside a date range, optionally one channel and region.

    Comparisons look only at the months that are present inside the filter.
    The order number behind RepeatOrders is over the customer's whole history.
    """
    first, last = date_range(start, end)
    if channel is not None:
        must_exist(t["sales_channels"], "ChannelName", channel, "channel")
    if region is not None:
        must_exist(t["addresses"], "Region", region, "region")
    orders = valid_orders(t, repeat=True, geography=region is not None)
    orders = orders.filter(in_range("OrderDateTime", first, last))
    if channel is not None:
        orders = orders.filter(F.col("ChannelName") == channel)
    if region is not None:
        orders = orders.filter(F.col("Region") == region)
    monthly = _totals(_customer_months(orders, "MonthStart"), "MonthStart").withColumn(
        "AverageOrderValue", ratio("NetRevenue", "Orders")
    )
    return (
        with_growth(with_comparisons(monthly))
        .select(
            "MonthStart", "Orders", "ActiveCustomers", "RepeatOrders", "NetRevenue",
            "RevenueAfterRefund", "GrossProfit", "AverageOrderValue", "RevenueMoMPct",
            "RevenueYoYPct", "Rolling3MonthRevenue", "RunningRevenue",
        )
        .orderBy("MonthStart")
    )


def executive_trend(t: Tables, start: dt.date | str, end: dt.date | str) -> DataFrame:
    first, last = date_range(start, end)
    return (
        monthly_performance(t)
        .filter(F.col("MonthStart").between(F.lit(first), F.lit(last)))
        .select(
            "MonthStart", "Orders", "ActiveCustomers", "NetRevenue", "RevenueAfterRefund",
            "GrossProfit", "AverageOrderValue", "RevenueMoMPct", "RevenueYoYPct",
            "Rolling3MonthRevenue", "Rolling12MonthRevenue", "RunningRevenue",
        )
        .orderBy("MonthStart")
    )


def annual_growth(t: Tables, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Which lever drives yearly growth: orders, customers or order value."""
    first, last = date_range(start, end)
    orders = (
        valid_orders(t)
        .filter(in_range("OrderDateTime", first, last))
        .withColumn("CalendarYear", F.year("OrderDate"))
    )
    per_customer = orders.groupBy("CustomerId", "CalendarYear").agg(
        F.count(F.lit(1)).alias("Orders"),
        sum_money("NetRevenue").alias("NetRevenue"),
        sum_money("GrossProfit").alias("GrossProfit"),
    )
    annual = (
        per_customer.groupBy("CalendarYear")
        .agg(
            F.sum("Orders").alias("Orders"),
            F.count(F.lit(1)).alias("ActiveCustomers"),
            F.sum("NetRevenue").alias("NetRevenue"),
            F.sum("GrossProfit").alias("GrossProfit"),
        )
        .withColumn("AverageOrderValue", ratio("NetRevenue", "Orders"))
    )
    years = Window.partitionBy(F.lit(0)).orderBy("CalendarYear")
    growth = {
        "RevenueYoYPct": "NetRevenue",
        "OrdersYoYPct": "Orders",
        "CustomersYoYPct": "ActiveCustomers",
        "AOVYoYPct": "AverageOrderValue",
    }
    return annual.withColumns(
        {name: growth_pct(c, F.lag(c).over(years)) for name, c in growth.items()}
    ).orderBy("CalendarYear")


def channel_by_year(
    t: Tables, start: dt.date | str, end: dt.date | str, years: list[int] | None = None
) -> DataFrame:
    """Revenue after refund per channel, one column per year, 0 where none."""
    first, last = date_range(start, end)
    columns = years or list(range(first.year, last.year + 1))
    orders = valid_orders(t).filter(in_range("OrderDateTime", first, last))
    wide = (
        orders.withColumn("OrderYear", F.year("OrderDate"))
        .groupBy("ChannelName")
        .pivot("OrderYear", columns)
        .agg(F.sum("RevenueAfterRefund"))
    )
    return wide.select(
        "ChannelName", *[zero_if_null(F.col(str(y))).alias(f"Revenue{y}") for y in columns]
    ).orderBy("ChannelName")


def regional_contribution(t: Tables) -> DataFrame:
    """Share, margin and repeat rate of each state, ranked by revenue."""
    orders = valid_orders(t, repeat=True, geography=True)
    keys = ["Region", "StateProvince"]
    regional = _totals(_customer_months(orders, *keys), *keys).withColumnRenamed(
        "ActiveCustomers", "Customers"
    )
    everything = Window.partitionBy(F.lit(0))  # states: a bounded list
    return regional.select(
        *keys,
        "Orders",
        "Customers",
        "NetRevenue",
        "GrossProfit",
        "RepeatOrders",
        ratio("NetRevenue", F.sum("NetRevenue").over(everything)).alias("RevenueShare"),
        ratio("GrossProfit", "NetRevenue").alias("GrossMarginRate"),
        ratio("RepeatOrders", "Orders").alias("RepeatOrderRate"),
        F.rank().over(everything.orderBy(F.col("NetRevenue").desc())).alias("RevenueRank"),
    ).orderBy("RevenueRank", *keys)


def region_channel(t: Tables) -> DataFrame:
    """Region by channel; the margin here is over revenue after refund."""
    orders = valid_orders(t, repeat=True, geography=True)
    keys = ["Region", "ChannelName"]
    totals = _totals(_customer_months(orders, *keys), *keys)
    return totals.select(
        *keys,
        "Orders",
        F.col("ActiveCustomers").alias("Customers"),
        "RevenueAfterRefund",
        "GrossProfit",
        "RepeatOrders",
        ratio("GrossProfit", "RevenueAfterRefund").alias("GrossMarginRate"),
        ratio("RepeatOrders", "Orders").alias("RepeatOrderRate"),
    )


def seasonality(t: Tables) -> DataFrame:
    """Average month by calendar month against the overall average month."""
    monthly = monthly_kpis(t)
    everything = Window.partitionBy(F.lit(0))
    by_number = monthly.groupBy("MonthNumber").agg(
        F.sum("RevenueAfterRefund").alias("__revenue"),
        F.sum("Orders").alias("__orders"),
        F.count(F.lit(1)).alias("__months"),
    )
    average = ratio("__revenue", "__months")
    overall = ratio(F.sum("__revenue").over(everything), F.sum("__months").over(everything))
    return by_number.select(
        "MonthNumber",
        average.alias("AverageMonthlyRevenue"),
        ratio("__orders", "__months").alias("AverageOrders"),
        (average / F.nullif(overall, F.lit(0.0))).alias("RevenueSeasonalityIndex"),
    )
