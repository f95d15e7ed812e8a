"""Customer revenue concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.functions import ratio
from orderwell.functions.ordered import Ordering, order_globally
from orderwell.operators.customers import customer_totals
from orderwell.operators.facts import Tables

SHARE_PERCENT = 80


def _ranked(t: Tables) -> DataFrame:
    value = "LifetimeRevenueAfterRefund"
    base = (
        customer_totals(t)
        .join(t["customers"].select("CustomerId"), "CustomerId", "left_semi")
        .filter(F.col(value) > 0)
        .select("CustomerId", F.col(value).cast("decimal(18,2)").alias(value))
    )
    ranked = order_globally(
        base,
        "CustomerId",
        [
            Ordering(
                value,
                descending=True,
                row_number="CustomerRank",
                running_sums={"CumulativeRevenue": value},
                total="CustomerCount",
            )
        ],
    )
    # Over the ranked rows: reads the written input again, not the facts.
    return ranked.withColumn("TotalRevenue", ranked.agg(F.sum(value)).scalar())


def pareto_curve(t: Tables) -> DataFrame:
    """Grain: purchasing customer, by value; cumulative shares of both."""
    return _ranked(t).select(
        "CustomerId",
        "LifetimeRevenueAfterRefund",
        "CustomerRank",
        ratio("CustomerRank", "CustomerCount").alias("CumulativeCustomerShare"),
        ratio("CumulativeRevenue", "TotalRevenue").alias("CumulativeRevenueShare"),
    )


def pareto_threshold(t: Tables, percent: int = SHARE_PERCENT) -> DataFrame:
    """The first customer at which the share is reached, compared exactly in decimals."""
    reached = F.col("CumulativeRevenue") * 100 >= F.col("TotalRevenue") * percent
    return (
        _ranked(t)
        .filter(reached)
        .orderBy("CustomerRank")
        .limit(1)
        .select(
            F.col("CustomerRank").alias("CustomersRequired"),
            ratio("CustomerRank", "CustomerCount").alias("CustomerShareRequired"),
            ratio("CumulativeRevenue", "TotalRevenue").alias("RevenueShareReached"),
        )
    )
