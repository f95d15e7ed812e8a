"""Sources: CSV round trips s01 and s03, row counts s07, snapshots s08."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oracle.catalog import query
from orderwell.plans.star import EXPORTS, Star
from orderwell.session import shared_folder
from orderwell.sources import files, snapshots
from orderwell.sources.files import row_counts

_TABLES = {
    "customer_segments": "segments", "customers": "customers", "addresses": "addresses", "categories": "categories", "products": "products",
    "sales_channels": "channels", "order_statuses": "statuses", "promotions": "promotions", "orders": "b_orders", "order_items": "items",
    "payments": "payments", "shipments": "shipments", "returns": "b_returns", "return_items": "return_items", "product_reviews": "reviews",
    "campaign_interactions": "interactions", "date_dimension": "calendar",
}
query(
    "s07_row_counts", "s: TableName i: Rows", " ".join(_TABLES.values()),
    " UNION ALL ".join(f"SELECT '{name}' AS TableName, COUNT(*) AS Rows FROM {piece}" for name, piece in _TABLES.items()),
)(row_counts)


def _folder(t) -> str:
    """A folder of its own in the shared one."""
    return f"{shared_folder(t['orders'].sparkSession).rstrip('/')}/orderwell/{uuid.uuid4().hex}"


@query(
    "s01_csv_round_trip", "i: CustomerId s: FirstName LastName Email d: AcquisitionDate s: AcquisitionSource i: SegmentId IsActive",
    "customers", r"""
SELECT CustomerId, concat('"', FirstName, '" ""') AS FirstName, concat(LastName, ', ', chr(10), '"', chr(10), CustomerId) AS LastName, Email,
       AcquisitionDate, AcquisitionSource, SegmentId, IsActive FROM customers""",
)
def csv_round_trip(t):
    """Quotes, doubled quotes, commas and line breaks in texts come back as they were."""
    folder, customers = _folder(t), t["customers"]
    awkward = customers.withColumns({
        "FirstName": F.concat(F.lit('"'), "FirstName", F.lit('" ""')),
        "LastName": F.concat("LastName", F.lit(', \n"\n'), F.col("CustomerId").cast("string")),
    })
    files.write_csv(awkward, f"{folder}/customers.csv")
    return files.read_table(customers.sparkSession, folder, "customers")


@query(
    "s03_rejects", "s: Kind i: Rows Total", "b_orders", """
SELECT 'rejected' AS Kind, COUNT(*) AS Rows, SUM(OrderId) AS Total FROM b_orders WHERE OrderId % 7 = 0
UNION ALL SELECT 'typed', COUNT(*), SUM(OrderId) FROM b_orders WHERE OrderId % 7 <> 0""",
)
def rejects(t):
    """Records whose amount is no number are kept as they are; all others are typed."""
    folder, orders = _folder(t), t["orders"]
    wrong = F.when(F.col("OrderId") % 7 == 0, F.concat(F.lit("n/a "), F.col("OrderId").cast("string")))
    files.write_csv(orders.withColumn("TaxAmount", F.coalesce(wrong, F.col("TaxAmount").cast("string"))), f"{folder}/orders.csv")
    good, bad = files.read_with_rejects(orders.sparkSession, folder, "orders")
    named = F.regexp_extract("Record", "n/a ([0-9]+)", 1).cast("bigint")
    return good.agg(F.lit("typed").alias("Kind"), F.count("TaxAmount").alias("Rows"), F.sum("OrderId").alias("Total")).unionByName(
        bad.agg(F.lit("rejected").alias("Kind"), F.count("Record").alias("Rows"), F.sum(named).alias("Total"))
    )


_DAYS = (dt.date(1995, 6, 30), dt.date(1996, 6, 30))


@query(
    "s08_snapshots", "s: Read d: SnapshotDate i: Customers Orders", "b_orders", f"""
WITH day AS (SELECT * FROM (VALUES ('first', DATE '{_DAYS[0]}'), ('latest', DATE '{_DAYS[1]}')) AS v(Read, SnapshotDate))
SELECT Read, SnapshotDate, COUNT(DISTINCT CustomerId) AS Customers, COUNT(*) AS Orders FROM b_orders JOIN day ON OrderDate <= SnapshotDate GROUP BY ALL""",
)
def two_snapshots(t):
    """Two days are written, the first one twice; each is read as last written."""
    spark, path = t["orders"].sparkSession, f"{_folder(t)}/orders_per_customer"

    def until(day, last):
        found = t["orders"].where(F.col("OrderDate").cast("date") <= F.lit(last)).groupBy("CustomerId").agg(F.count(F.lit(1)).alias("Orders"))
        return found.withColumn("SnapshotDate", F.lit(day))

    for day, last in ((_DAYS[0], _DAYS[1]), (_DAYS[1], _DAYS[1]), (_DAYS[0], _DAYS[0])):
        snapshots.write_snapshot(until(day, last), path)
    first = snapshots.read_snapshot(spark, path, _DAYS[0]).withColumn("Read", F.lit("first"))
    both = first.unionByName(snapshots.read_snapshot(spark, path).withColumn("Read", F.lit("latest")))
    return both.groupBy("Read", "SnapshotDate").agg(F.count(F.lit(1)).alias("Customers"), F.sum("Orders").alias("Orders"))


@query(
    "s09_published_snapshots", "s: Read d: SnapshotDate i: Customers Orders", "b_orders", f"""
WITH day AS (SELECT * FROM (VALUES ('first', DATE '{_DAYS[0]}'), ('between', DATE '{_DAYS[0]}'), ('latest', DATE '{_DAYS[1]}')) AS v(Read, SnapshotDate))
SELECT Read, SnapshotDate, COUNT(DISTINCT CustomerId) AS Customers, COUNT(*) AS Orders FROM b_orders JOIN day ON OrderDate <= SnapshotDate GROUP BY ALL""",
)
def published(t):
    """Both days in one write, the first one replaced by another; read by day, as of a day between, and the latest."""
    spark, path = t["orders"].sparkSession, f"{_folder(t)}/published"

    def until(day, last):
        found = t["orders"].where(F.col("OrderDate").cast("date") <= F.lit(last)).groupBy("CustomerId").agg(F.count(F.lit(1)).alias("Orders"))
        return found.withColumn("SnapshotDate", F.lit(day))

    snapshots.publish_snapshot(until(_DAYS[0], _DAYS[1]).unionByName(until(_DAYS[1], _DAYS[1])), path)
    snapshots.publish_snapshot(until(_DAYS[0], _DAYS[0]), path)
    reads = {"first": dict(day=_DAYS[0]), "between": dict(as_of=_DAYS[1] - dt.timedelta(days=1)), "latest": {}}
    found = [snapshots.read_published(spark, path, **which).withColumn("Read", F.lit(name)) for name, which in reads.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy("Read", "SnapshotDate").agg(
        F.count(F.lit(1)).alias("Customers"), F.sum("Orders").alias("Orders")
    )


_EXPORTED = {
    "dim_products": ("products", "SUM(UnitCost)", "UnitCost"), "fact_reviews": ("reviews", "SUM(Rating)", "Rating"),
    "fact_order_lines": ("order_lines", "SUM(NetRevenue)", "NetRevenue"), "fact_orders": ("order_summary", "SUM(RefundAmount)", "RefundAmount"),
}
_SHARED = "products reviews order_lines order_summary"
_EXPORT_SQL = " UNION ALL ".join(
    f"SELECT '{file}' AS TableName, COUNT(*) AS Rows, COUNT(*) AS ReadBack, {total} AS Total, 0 AS Changed FROM {source}"
    for file, (source, total, _) in _EXPORTED.items()
)


def _export(as_csv: bool):
    def build(t):
        spark, folder, built = t["orders"].sparkSession, _folder(t), Star(t)
        written = files.export_star(built, folder, as_csv, only=_EXPORTED, run={"SnapshotDate": str(_DAYS[1])})
        if as_csv:
            back = files.read_export(spark, folder, built, only=_EXPORTED)
        else:
            back = {table: spark.read.parquet(f"{folder}/{file}") for file, table, _ in EXPORTS if file in _EXPORTED}
        parts = [
            back[table].agg(F.lit(file).alias("TableName"), F.count(F.lit(1)).alias("ReadBack"), F.sum(_EXPORTED[file][2]).cast("double").alias("Total"))
            for file, table, _ in EXPORTS if file in _EXPORTED
        ]
        read = reduce(DataFrame.unionByName, parts)
        changed = files.changed_files(spark, folder).groupBy("TableName").agg(F.count(F.lit(1)).alias("Changed"))
        return written.select("TableName", "Rows").join(read, "TableName", "left").join(changed, "TableName", "left").fillna(0, ["Changed"])

    return build


for _name, _as_csv in (("s05_export_as_csv", True), ("s05b_export_as_parquet", False)):
    query(_name, "s: TableName i: Rows ReadBack f: Total i: Changed", _SHARED, _EXPORT_SQL)(_export(_as_csv))
