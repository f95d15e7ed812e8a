"""Calendar dimension: one row per day with eleven attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.functions import date_key

TRAILING_DAYS = 365


def calendar_between(bounds: DataFrame, trailing_days: int = TRAILING_DAYS) -> DataFrame:
    """Days from ``first_day`` to ``last_day`` + trailing days of a one-row frame."""
    days = bounds.select(
        F.explode(
            F.sequence(
                F.col("first_day"),
                F.date_add("last_day", trailing_days),
                F.expr("INTERVAL 1 DAY"),
            )
        ).alias("FullDate")
    )
    day = F.col("FullDate")
    return days.select(
        date_key(day).alias("DateKey"),
        day,
        F.year(day).alias("CalendarYear"),
        F.quarter(day).alias("CalendarQuarter"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.date_format(day, "yyyy-MM").alias("YearMonth"),
        F.weekofyear(day).alias("WeekOfYear"),
        F.dayofmonth(day).alias("DayOfMonth"),
        F.date_format(day, "EEEE").alias("DayName"),
        F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0).alias("IsWeekend"),
    )


def order_calendar(orders: DataFrame, trailing_days: int = TRAILING_DAYS) -> DataFrame:
    bounds = orders.agg(
        F.min("OrderDate").cast("date").alias("first_day"),
        F.max("OrderDate").cast("date").alias("last_day"),
    )
    return calendar_between(bounds, trailing_days)
