"""One row per check, an overall status, and a fail-fast option."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.operators.facts import SharedOrders, Tables
from orderwell.quality import checks
from orderwell.session import Stored, materialize
from orderwell.sources.contracts import SourceError

ROW_CHECKS = {
    "orders_without_lines": checks.orders_without_lines,
    "address_owner": checks.address_owner,
    "payment_reconciliation": checks.payment_reconciliation,
    "shipment_chronology": checks.shipment_chronology,
    "return_quantity": checks.return_quantity,
    "promotion_code": checks.promotion_code,
    "verified_review": checks.verified_review,
    "conversion_order": checks.conversion_order,
    "order_sequence": checks.order_sequence,
    "refund_bounds": checks.refund_bounds,
    "conversions_match_orders": checks.conversions_match_orders,
}

# The checks that decide whether the sources may be used at all.
BLOCKING = (
    "unexpected_nulls:", "null_key:", "duplicate_key:", "foreign_key:", "range:", "grain:", "rows:refund_bounds",
    "unique:shipments.OrderId",  # order facts join shipments by order: a second one would double the order
)

# The tables with rows for an order's lines and payments: many checks read them, so they are built once.
STORED = ("order_items", "payments", "return_items", "product_reviews")

# What is told of outliers that are found but kept.
OUTLIERS_KEPT = {"high_value_order_lines": "unusually high order lines are kept: they may be real orders"}


def quality_report(t: Tables) -> DataFrame:
    """All checks as (CheckName, Violations, Status, Blocking).

    Every check is an aggregate on the cluster; the report has one row per check.  What several checks read is written
    once: the larger tables and the orders' totals.  Each check's counts are written as well, so that the disks hold what
    one check has shuffled, not what all of them have.
    """
    t = SharedOrders(Stored(t, STORED))
    parts: list[DataFrame] = []
    nulls = checks.null_profile(t)
    parts.append(
        nulls.select(
            F.concat(F.lit("unexpected_nulls:"), "TableName").alias("CheckName"),
            F.col("UnexpectedNulls").alias("Violations"),
        )
    )
    parts.append(checks.key_checks(t))
    grouped = {
        "range:": lambda t: checks.value_ranges(t).unionByName(checks.delivery_order(t)),
        "rule:": checks.check_constraints,
        "grain:": checks.grain_reconciliation,
    }
    for prefix, check in grouped.items():
        parts.append(
            check(t).select(F.concat(F.lit(prefix), "CheckName").alias("CheckName"), "Violations")
        )
    for name, check in ROW_CHECKS.items():
        parts.append(
            check(t)
            .agg(F.count(F.lit(1)).alias("Violations"))
            .select(F.lit(f"rows:{name}").alias("CheckName"), "Violations")
        )
    blocking = reduce(lambda a, b: a | b, [F.col("CheckName").startswith(p) for p in BLOCKING])
    return reduce(DataFrame.unionByName, [materialize(part) for part in parts]).select(
        "CheckName",
        "Violations",
        F.when(F.col("Violations") == 0, "PASS").otherwise("FAIL").alias("Status"),
        blocking.cast("int").alias("Blocking"),
    )


def quality_profile(t: Tables) -> DataFrame:
    """What the report tells besides its checks, as (Kind, Name, Value, Warning).

    Kinds: rows, unexpected_nulls and expected_nulls of each table, and outliers. A warning is given with outliers that
    were found and kept; it is null elsewhere. One scan per table for its rows and nulls.
    """
    kinds = {"rows": "Rows", "unexpected_nulls": "UnexpectedNulls", "expected_nulls": "ExpectedNulls"}
    counted = F.array(*[F.struct(F.lit(k).alias("Kind"), F.col(c).alias("Value")) for k, c in kinds.items()])
    nothing = F.lit(None).cast("string")
    tables = checks.null_profile(t).select(F.col("TableName").alias("Name"), F.inline(counted))
    warning = nothing
    for name, text in OUTLIERS_KEPT.items():
        warning = F.when((F.col("CheckName") == name) & (F.col("Rows") > 0), F.lit(text)).otherwise(warning)
    outliers = checks.outliers(t).select(
        F.lit("outliers").alias("Kind"), F.col("CheckName").alias("Name"), F.col("Rows").alias("Value"),
        warning.alias("Warning"),
    )
    return tables.select("Kind", "Name", "Value", nothing.alias("Warning")).unionByName(outliers)


def overall(report: DataFrame) -> DataFrame:
    """Status, passed and failed checks in one row."""
    failed = F.count(F.when(F.col("Status") == "FAIL", F.lit(1)))
    stopped = F.count(F.when((F.col("Status") == "FAIL") & (F.col("Blocking") == 1), F.lit(1)))
    return report.agg(
        F.when(stopped > 0, "FAIL").otherwise("PASS").alias("Status"),
        (F.count(F.lit(1)) - failed).alias("ChecksPassed"),
        failed.alias("ChecksFailed"),
    )


def require_quality(report: DataFrame) -> DataFrame:
    """Raise when a blocking check failed; the report has one row per check, so all names are read."""
    failed = report.filter((F.col("Status") == "FAIL") & (F.col("Blocking") == 1))
    names = [row["CheckName"] for row in failed.select("CheckName").collect()]
    if names:
        raise SourceError("; ".join(sorted(names)))
    return report
