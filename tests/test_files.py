"""CSV contracts, typed loads, snapshots, exports and manifests."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderwell.operators import customers
from orderwell.plans.star import EXPORTS, Star, relationship_audit
from orderwell.quality import report
from orderwell.sources import files, snapshots
from orderwell.sources.contracts import CONTRACTS, SourceError
from shop import shop, table, when


@pytest.fixture(scope="module")
def tables(spark):
    ids = range(1, 8)
    return shop(
        spark,
        customers=[dict(CustomerId=i) for i in ids],
        addresses=[dict(AddressId=i, CustomerId=i) for i in ids],
        orders=[dict(OrderId=i, CustomerId=i, ShippingAddressId=i, OrderDate=when(f"2024-01-{i:02d}T10:00:00")) for i in ids],
        order_items=[dict(OrderItemId=i, OrderId=i, Quantity=i) for i in ids],
        payments=[dict(PaymentId=i, OrderId=i, PaymentDate=when("2024-01-01"), Amount=Decimal(10 * i)) for i in ids],
    )


@pytest.fixture(scope="module")
def csv_folder(tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    for name, df in tables.items():
        df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{folder}/{name}.csv")
    return folder


def test_csv_round_trip(spark, tables, csv_folder):
    read = files.read_sources(spark, csv_folder)
    for name, df in read.items():
        assert df.schema.fieldNames() == CONTRACTS[name].columns
        assert sorted(map(str, df.collect())) == sorted(map(str, tables[name].select(df.columns).collect())), name


def test_missing_table_and_column(spark, tables, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path), "orders")
    tables["orders"].drop("CustomerId").write.option("header", True).csv(f"{tmp_path}/orders.csv")
    with pytest.raises(SourceError):
        files.read_table(spark, str(tmp_path), "orders")


def test_quoted_fields_headers_and_rejects(spark, tmp_path):
    folder = tmp_path / "customer_segments.csv"
    folder.mkdir()
    text = 'SegmentId,SegmentName,Description,Extra\n1,"a ""b"", c","line\nbreak",x\n2,plain,,\n'
    (folder / "part-0.csv").write_text(text)
    rows = sorted(map(tuple, files.read_table(spark, str(tmp_path), "customer_segments").collect()))
    assert rows == [(1, 'a "b", c', "line\nbreak"), (2, "plain", None)]
    (folder / "part-1.csv").write_text("SegmentId,SegmentName,Description,Extra\nseven,x,y,z\n,no key,,\n8,short\n9,fine,,\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_table(spark, str(tmp_path), "customer_segments").collect()
    good, bad = files.read_with_rejects(spark, str(tmp_path), "customer_segments")
    assert sorted(r["SegmentId"] for r in good.collect()) == [1, 2, 9]
    found = {r["Record"]: r["MissingKey"] for r in bad.collect()}
    assert len(found) == 3 and found["seven,x,y,z"] is False and found["8,short"] is False and True in found.values()
    # another file's columns in another order are an error, not shifted values
    (folder / "part-2.csv").write_text("SegmentName,SegmentId,Description,Extra\nx,10,,\n")
    with pytest.raises(Exception, match="header|Header|HEADER"):
        files.read_table(spark, str(tmp_path), "customer_segments").where("SegmentId = 10").collect()


def test_typed_load_replaces(spark, tables, csv_folder, tmp_path):
    for _ in range(2):
        loaded = files.load_typed(spark, csv_folder, str(tmp_path / "typed"))
    same = files.changed_tables(
        files.manifest({n: tables[n].select(CONTRACTS[n].columns) for n in ("orders", "order_items")}),
        files.manifest(loaded, ["orders", "order_items"]),
    )
    assert same.count() == 0
    changed = {**loaded, "orders": loaded["orders"].withColumn("TaxAmount", F.lit(1).cast("decimal(12,2)"))}
    differs = files.changed_tables(files.manifest(loaded, ["orders"]), files.manifest(changed, ["orders"]))
    assert [r["TableName"] for r in differs.collect()] == ["orders"]


def test_snapshot_replaces_one_day(spark, tables, tmp_path):
    path = str(tmp_path / "rfm")
    customers.refresh_rfm(tables, path, "2024-01-05")
    customers.refresh_rfm(tables, path)
    before = spark.read.parquet(path).count()
    summary = customers.refresh_rfm(tables, path, "2024-01-05")
    assert spark.read.parquet(path).count() == before == 5 + 7
    assert sum(r["Customers"] for r in summary.collect()) == 5
    latest = snapshots.latest_segment_summary(spark, path).collect()
    assert {str(r["SnapshotDate"]) for r in latest} == {"2024-01-08"}
    assert sum(r["Customers"] for r in latest) == 7


def test_export_writes_all_tables(spark, tables, tmp_path):
    star = Star(tables)
    counts = {r["TableName"]: r["Rows"] for r in files.export_star(star, str(tmp_path / "star")).collect()}
    assert set(counts) == {file for file, _, _ in EXPORTS} and len(counts) == 22
    assert counts["fact_orders"] == counts["fact_order_lines"] == 7
    csv = files.export_star(star, str(tmp_path / "csv"), as_csv=True)
    assert {r["TableName"]: r["Rows"] for r in csv.collect()} == counts
    orders = files.read_export(spark, str(tmp_path / "csv"), star)["FactOrders"]
    assert orders.schema == star["FactOrders"].schema or orders.columns == star["FactOrders"].columns
    assert orders.agg(F.sum("NetRevenue")).first()[0] == 280


def test_export_manifest_tells_broken_files(spark, tables, tmp_path):
    star, folder = Star(tables), str(tmp_path / "export")
    for as_csv in (True, False):
        written = files.export_star(star, folder, as_csv, only=["dim_products", "fact_orders"], run={"SnapshotDate": "2024-01-08"})
        assert {(r["TableName"], r["Rows"], r["Run"]) for r in written.collect()} == {
            ("dim_products", tables["products"].count(), '{"SnapshotDate": "2024-01-08"}'), ("fact_orders", 7, '{"SnapshotDate": "2024-01-08"}')}
        assert files.changed_files(spark, folder).count() == 0
    # a value, a lost row and a doubled row each show, and an export of an empty table is one as well
    products = star["DimProduct"]
    for broken in (products.withColumn("UnitCost", F.col("UnitCost") + 1), products.limit(1), products.unionByName(products)):
        broken.write.mode("overwrite").parquet(f"{folder}/dim_products")
        assert [r["TableName"] for r in files.changed_files(spark, folder).collect()] == ["dim_products"]
    empty = Star({**tables, "products": tables["products"].limit(0)})
    assert files.export_star(empty, folder, only=["dim_products"]).first()["Rows"] == 0
    assert files.changed_files(spark, folder).count() == 0
    with pytest.raises(ValueError, match="no such export"):
        files.export_star(star, folder, only=["fact_nothing"])


def test_published_snapshots_change_by_one_line(spark, tmp_path):
    path = str(tmp_path / "store")

    def rows(day, *ids):
        return spark.createDataFrame([(i, f"n{i}", day) for i in ids], "id int, name string, SnapshotDate string")

    snapshots.publish_snapshot(rows("2024-01-01", 1, 2).unionByName(rows("2024-01-03", 3)), path)
    begun = snapshots.read_published(spark, path, dt.date(2024, 1, 1))
    snapshots.publish_snapshot(rows("2024-01-01", 4, 5, 6), path)
    # a write that broke off before its line leaves a folder that nobody reads
    rows("2024-01-01", 9).write.partitionBy("SnapshotDate").parquet(f"{path}/runs/broken")

    def ids(df):
        return sorted((r["id"], r["name"], str(r["SnapshotDate"])) for r in df.collect())

    assert ids(begun) == [(1, "n1", "2024-01-01"), (2, "n2", "2024-01-01")]
    assert [i for i, *_ in ids(snapshots.read_published(spark, path, dt.date(2024, 1, 1)))] == [4, 5, 6]
    assert ids(snapshots.read_published(spark, path)) == [(3, "n3", "2024-01-03")]
    assert [i for i, *_ in ids(snapshots.read_published(spark, path, as_of=dt.date(2024, 1, 2)))] == [4, 5, 6]
    assert {str(r["SnapshotDate"]): r["Rows"] for r in snapshots.published_days(spark, path).collect()} == {"2024-01-01": 3, "2024-01-03": 1}
    assert snapshots.superseded_runs(spark, path).count() == 0  # the first run still serves the third of January
    snapshots.publish_snapshot(rows("2024-01-03", 7), path)
    assert snapshots.superseded_runs(spark, path).count() == 1
    for early in (dict(day=dt.date(2024, 1, 2)), dict(as_of=dt.date(2023, 12, 31))):
        with pytest.raises(SourceError, match="no snapshot"):
            snapshots.read_published(spark, path, **early)
    with pytest.raises(SourceError, match="SnapshotDate in every row"):
        snapshots.publish_snapshot(rows(None, 8), path)
    assert ids(snapshots.read_published(spark, path)) == [(7, "n7", "2024-01-03")]


def test_relationships_hold(tables):
    for r in relationship_audit(Star(tables)).collect():
        assert (r["DuplicateKeys"], r["Orphans"]) == (0, 0), r


def test_quality_report_and_fail_fast(spark, tables):
    good = report.quality_report(tables)
    assert report.require_quality(good) is good
    assert report.overall(good).first()["Status"] == "PASS"
    bad = {**tables, "order_items": tables["order_items"].withColumn("ProductId", F.lit(99).cast("long"))}
    with pytest.raises(SourceError, match="foreign_key:order_items.ProductId"):
        report.require_quality(report.quality_report(bad))
    empty = {**tables, "orders": tables["orders"].withColumn("CustomerId", F.lit(None).cast("long"))}
    with pytest.raises(SourceError, match="unexpected_nulls:orders"):
        report.require_quality(report.quality_report(empty))


def test_late_shipments_and_negative_refunds_block(spark, tables):
    sent = dict(ShipmentId=1, OrderId=1, ShippedDate=when("2024-03-05"), DeliveredDate=when("2024-03-04"))
    late = {**tables, "shipments": table(spark, "shipments", [sent])}
    with pytest.raises(SourceError, match="range:delivery_not_before_shipment"):
        report.require_quality(report.quality_report(late))
    returned = {
        "returns": table(spark, "returns", [dict(ReturnId=1, OrderId=1, CustomerId=1)]),
        "return_items": table(spark, "return_items", [dict(ReturnItemId=1, ReturnId=1, OrderItemId=1, RefundAmount=Decimal(-2))]),
    }
    with pytest.raises(SourceError, match="rows:refund_bounds"):
        report.require_quality(report.quality_report({**tables, **returned}))


def test_profile_counts_rows_nulls_and_outliers(tables):
    got = {(r["Kind"], r["Name"]): (r["Value"], r["Warning"]) for r in report.quality_profile(tables).collect()}
    for name in ("orders", "shipments", "product_reviews"):
        assert got["rows", name] == (tables[name].count(), None)
    assert got["unexpected_nulls", "orders"] == (0, None) and ("outliers", "delivery_over_14_days") in got
    one = tables["order_items"].limit(1)
    many = {**tables, "order_items": one.select("*", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("i")).drop("i").unionByName(
        one.withColumn("UnitPrice", (F.col("UnitPrice") * 1000).cast(one.schema["UnitPrice"].dataType)))}
    warned = {r["Name"]: (r["Value"], r["Warning"]) for r in report.quality_profile(many).where("Kind = 'outliers'").collect()}
    assert warned["high_value_order_lines"] == (1, report.OUTLIERS_KEPT["high_value_order_lines"])
