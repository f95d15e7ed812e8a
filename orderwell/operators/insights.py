"""Executive scorecard and quantified findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.functions import ratio
from orderwell.functions.scalars import count_if
from orderwell.operators.concentration import pareto_threshold
from orderwell.operators.customers import (
    AT_RISK_STATUSES,
    churn_summary,
    cohort_retention,
    customer_totals,
)
from orderwell.operators.facts import SharedOrders, Tables, is_valid, order_facts, valid_orders
from orderwell.operators.marketing import (
    acquisition_performance,
    campaign_performance,
    discount_effectiveness,
)
from orderwell.operators.operations import delivery_performance, rating_returns
from orderwell.operators.products import category_performance
from orderwell.operators.sales import monthly_performance_fractions, seasonality
from orderwell.session import materialize


def executive_scorecard(t: Tables) -> DataFrame:
    """Thirteen headline metrics in one row."""
    t = t if isinstance(t, SharedOrders) else SharedOrders(t)
    valid = is_valid()

    def total(column: str) -> Column:
        return F.sum(F.when(valid, F.col(column)))

    orders = count_if(valid)
    delivered = valid & F.col("DeliveredDate").isNotNull()
    on_time = F.sum(F.when(delivered, F.col("IsOnTime")))
    buyers = customer_totals(t).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), count_if(F.col("LifetimeOrders") >= 2).alias("repeat")
        )
    ).scalar()
    customers = t["customers"].agg(F.count(F.lit(1))).scalar()
    latest = (
        monthly_performance_fractions(t)
        .orderBy(F.col("MonthStart").desc())
        .limit(1)
        .select("RevenueYoYPct")
        .scalar()
    )
    return (
        order_facts(t, repeat=True, shipment=True)
        .agg(
            F.max("OrderDate").alias("AsOfDate"),
            orders.alias("Orders"),
            total("NetRevenue").alias("NetRevenue"),
            total("RevenueAfterRefund").alias("RevenueAfterRefund"),
            total("GrossProfit").alias("GrossProfit"),
            ratio(total("GrossProfit"), total("NetRevenue")).alias("GrossMarginRate"),
            ratio(total("NetRevenue"), orders).alias("AverageOrderValue"),
            ratio(total("IsRepeatPurchase"), orders).alias("RepeatOrderRate"),
            ratio(total("RefundAmount"), total("NetRevenue")).alias("RefundLeakageRate"),
            ratio(on_time, count_if(delivered)).alias("OnTimeDeliveryRate"),
        )
        .withColumns(
            {
                "CustomersWithOrders": buyers.getField("n"),
                "RepeatCustomerRate": ratio(buyers.getField("repeat"), customers),
                "LatestMonthYoYGrowth": latest,
            }
        )
    )


def _finding(
    df: DataFrame,
    priority: int,
    name: str,
    value: Column | str,
    comparison: Column | str | None = None,
    subject: Column | str | None = None,
) -> DataFrame:
    def column(c: Column | str | None, kind: str) -> Column:
        picked = F.lit(None) if c is None else (F.col(c) if isinstance(c, str) else c)
        return picked.cast(kind)

    return df.select(
        F.lit(priority).alias("Priority"),
        F.lit(name).alias("Finding"),
        column(subject, "string").alias("Subject"),
        column(value, "double").alias("Value"),
        column(comparison, "double").alias("Comparison"),
    )


def _top(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(1)


def insights(t: Tables) -> DataFrame:
    """One row per finding: who or what leads, its value and what it compares with.

    Relations that several findings read are written once: the order facts, and the few rows of the scorecard and categories.
    """
    t = SharedOrders(t)
    scorecard = materialize(executive_scorecard(t))
    wanted = ["CategoryName", "GrossProfit", "GrossMarginRate", "UnitReturnRate", "RefundAmount"]
    categories = materialize(category_performance(t).select(*wanted))
    name = F.col("CategoryName")
    rated = rating_returns(t).agg(
        ratio(
            F.sum(F.when(F.col("Rating") <= 2, F.col("ReturnedReviews"))),
            F.sum(F.when(F.col("Rating") <= 2, F.col("Reviews"))),
        ).alias("low"),
        ratio(
            F.sum(F.when(F.col("Rating") >= 4, F.col("ReturnedReviews"))),
            F.sum(F.when(F.col("Rating") >= 4, F.col("Reviews"))),
        ).alias("high"),
    )
    promoted = F.col("PromotionGroup") == "Promotion"

    def per_order(condition: Column) -> Column:
        return ratio(
            F.sum(F.when(condition, F.col("GrossProfit"))), F.sum(F.when(condition, F.col("Orders")))
        )

    promotion = discount_effectiveness(valid_orders(t)).agg(
        per_order(promoted).alias("with"), per_order(~promoted).alias("without")
    )
    month_one = cohort_retention(t).filter(F.col("MonthsSinceFirstOrder") == 1)
    risk = churn_summary(t).filter(F.col("LifecycleStatus").isin(*AT_RISK_STATUSES))
    lanes = delivery_performance(t).filter(F.col("DeliveredOrders") >= 100)
    findings = [
        _finding(scorecard, 1, "refund_leakage", "RevenueAfterRefund", "RefundLeakageRate"),
        _finding(scorecard, 2, "latest_year_over_year", "LatestMonthYoYGrowth"),
        _finding(
            _top(seasonality(t), F.col("RevenueSeasonalityIndex").desc(), "MonthNumber"),
            3, "seasonal_peak", "RevenueSeasonalityIndex", None, "MonthNumber",
        ),
        _finding(
            _top(acquisition_performance(t), F.col("RevenuePerPurchaser").desc(), "AcquisitionSource"),
            4, "best_acquisition_source", "RevenuePerPurchaser", None, "AcquisitionSource",
        ),
        _finding(scorecard, 5, "repeat_behavior", "RepeatCustomerRate", "RepeatOrderRate"),
        _finding(
            month_one.agg(F.round(F.avg("RetentionRate"), 9).alias("m1")),
            6, "month_one_retention", "m1",
        ),
        _finding(
            risk.agg(F.sum("RevenueAtRisk").alias("risk")), 7, "revenue_at_risk", "risk"
        ),
        _finding(
            _top(categories, F.col("GrossProfit").desc(), name),
            8, "profit_category", "GrossProfit", "GrossMarginRate", name,
        ),
        _finding(
            _top(categories, F.col("UnitReturnRate").desc(), name),
            9, "return_category", "UnitReturnRate", "RefundAmount", name,
        ),
        _finding(
            _top(lanes, "OnTimeRate", "AverageDeliveryDays", "Carrier", "Region"),
            10, "weakest_lane", "OnTimeRate", "DeliveredOrders",
            F.concat_ws(" / ", "Carrier", "Region"),
        ),
        _finding(
            _top(campaign_performance(t), F.col("AttributedGrossProfit").desc(), "PromotionId"),
            11, "profit_campaign", "AttributedGrossProfit", None, "PromotionName",
        ),
        _finding(pareto_threshold(t), 12, "concentration", "CustomerShareRequired"),
        _finding(rated, 13, "low_rating_returns", "low", "high"),
        _finding(
            promotion, 14, "promotion_profit_delta", F.col("with") / F.col("without") - 1
        ),
    ]
    return reduce(DataFrame.unionByName, findings).orderBy("Priority")
