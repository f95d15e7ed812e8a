"""Projection of an order/line/part star schema onto the commerce tables.

Lines carry no key of their own, so a line is identified by its own columns:
unlike a row number that needs no shuffle and has no hot order.
``dirty=True`` seeds violations for the data-quality checks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.sources.calendar import order_calendar
from orderwell.sources.contracts import (
    ACQUISITION_SOURCES,
    CONTRACTS,
    INTERACTION_CHANNELS,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    RETURN_REASONS,
    SALES_CHANNELS,
)

# The codes of the star schema.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRODUCT_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CARRIERS = ("UPS", "FedEx", "DHL", "USPS")
PROMOTIONS = 18
TABLES = tuple(CONTRACTS)

# Columns that identify a line, as whole numbers: cheap to print, exact to compare.
LINE_ID = """concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT),
    CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT), unix_date(CAST(l_shipdate AS DATE)))"""

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}

# Decimals just wide enough stay in a machine word through the multiplications.
# Prices are converted on the part side, once per part rather than once per line.
PRICE = "CAST(p_retailprice AS DECIMAL(8,2))"
COST = f"CAST({PRICE} * CAST(40 + p_size AS DECIMAL(3,0)) * 0.01 AS DECIMAL(12,2))"
QUANTITY = "CAST(CAST(l_quantity AS INT) AS DECIMAL(4,0))"
# Whole percent to decimal: cheaper than printing the double, and the same value.
SHARE_OFF = (
    "CAST(CAST(CAST(floor(l_discount * 100 + 0.5) AS INT) AS DECIMAL(3,0)) * 0.01 AS DECIMAL(3,2))"
)

RETURNED = "l_returnflag = 'R'"
CANCELLED = "o_orderstatus = 'P' AND (o_orderkey DIV 7) % 10 < 3"


def _pick(values: tuple[str, ...], index: str) -> str:
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {branches} END"


def _listing(spark: SparkSession, names: tuple[str, ...], columns: str) -> DataFrame:
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(names, 1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def _categories(spark: SparkSession) -> DataFrame:
    parents = [f"({i}, '{name}', CAST(NULL AS INT))" for i, name in enumerate(PRODUCT_TYPES, 1)]
    children = [
        f"({6 + 4 * (i - 1) + k + 1}, '{name}-{k}', {i})"
        for i, name in enumerate(PRODUCT_TYPES, 1)
        for k in range(4)
    ]
    listed = ", ".join(parents + children)
    return spark.sql(
        f"SELECT * FROM VALUES {listed} AS t(CategoryId, CategoryName, ParentCategoryId)"
    )


def _promotions(spark: SparkSession) -> DataFrame:
    # One partition, so that a join on 18 rows does not cost a task per core.
    return spark.range(1, PROMOTIONS + 1, numPartitions=1).selectExpr(
        "CAST(id AS INT) AS PromotionId",
        "concat('PROMO', lpad(CAST(id AS STRING), 2, '0')) AS PromotionCode",
        "concat('Campaign ', CAST(id AS STRING)) AS PromotionName",
        f"{_pick(('Percentage', 'Fixed Amount', 'Free Shipping'), 'id % 3')} AS PromotionType",
        "CAST(5 + (id % 4) * 5 AS DECIMAL(12,2)) AS DiscountValue",
        "CAST((id % 4) * 50 AS DECIMAL(12,2)) AS MinimumOrderValue",
        "CAST(date_add(DATE'1995-01-01', CAST((id - 1) * 120 AS INT)) AS TIMESTAMP_NTZ)"
        " AS StartDate",
        "CAST(date_add(DATE'1995-01-31', CAST((id - 1) * 120 AS INT)) AS TIMESTAMP_NTZ)"
        " AS EndDate",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(1 + id % 4 AS INT) END AS ChannelId",
    )


class StarTables(Mapping):
    """The seventeen commerce tables, each projected on first use."""

    def __init__(self, spark: SparkSession, folder: str, dirty: bool = False):
        self.spark, self.folder, self.dirty = spark, folder, dirty
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def raw(self, name: str) -> DataFrame:
        # A declared schema saves the job that would read file footers.
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def seeded(self, condition: str, broken: str, clean: str) -> str:
        return f"CASE WHEN {condition} THEN {broken} ELSE {clean} END" if self.dirty else clean

    def customer_segments(self) -> DataFrame:
        return _listing(self.spark, SEGMENTS, "SegmentId, SegmentName").withColumn(
            "Description", F.col("SegmentName")
        )

    def sales_channels(self) -> DataFrame:
        return _listing(self.spark, SALES_CHANNELS, "ChannelId, ChannelName")

    def order_statuses(self) -> DataFrame:
        return _listing(self.spark, ORDER_STATUSES, "StatusId, StatusName")

    def categories(self) -> DataFrame:
        return _categories(self.spark)

    def promotions(self) -> DataFrame:
        return _promotions(self.spark)

    def customers(self) -> DataFrame:
        segment_id = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEGMENTS, 1))
        acquired = "date_add(DATE'1994-07-01', CAST(c_custkey % 700 AS INT))"
        return self.raw("customer").selectExpr(
            "c_custkey AS CustomerId",
            "'Customer' AS FirstName",
            "split_part(c_name, '#', 2) AS LastName",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') AS Email",
            "CAST(NULL AS STRING) AS Phone",
            f"{acquired} AS AcquisitionDate",
            f"{_pick(ACQUISITION_SOURCES, 'c_custkey % 6')} AS AcquisitionSource",
            f"CASE c_mktsegment {segment_id} END AS SegmentId",
            "CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS IsActive",
            f"CAST({acquired} AS TIMESTAMP_NTZ) AS CreatedAt",
        )

    def addresses(self) -> DataFrame:
        places = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.raw("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey + 1 AS AddressId",
                "c_custkey AS CustomerId",
                "'Shipping' AS AddressType",
                "concat('1 ', c_name) AS AddressLine1",
                "n_name AS City",
                "n_name AS StateProvince",
                "r_name AS Region",
                "'00000' AS PostalCode",
                "'US' AS CountryCode",
                "1 AS IsDefault",
            )
        )

    def products(self) -> DataFrame:
        type_number = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(PRODUCT_TYPES))
        return self.raw("part").selectExpr(
            "p_partkey AS ProductId",
            "concat('SKU', lpad(CAST(p_partkey AS STRING), 9, '0')) AS SKU",
            "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS ProductName",
            "p_brand AS BrandName",
            f"7 + 4 * (CASE p_type {type_number} END) + p_size % 4 AS CategoryId",
            f"{COST} AS UnitCost",
            f"CAST({PRICE} AS DECIMAL(12,2)) AS ListPrice",
            "date_add(DATE'1994-01-01', CAST(p_partkey % 365 AS INT)) AS LaunchDate",
            "1 AS IsActive",
        )

    def orders(self) -> DataFrame:
        promoted = "CASE WHEN (o_orderkey DIV 16) % 6 = 0 THEN {} END"
        number = "1 + (o_orderkey DIV 96) % 18"
        promotion = promoted.format(f"CAST({number} AS INT)")
        code = promoted.format(f"concat('PROMO', lpad(CAST({number} AS STRING), 2, '0'))")
        address = self.seeded(
            "o_orderkey % 997 = 0", "CASE WHEN o_custkey = 0 THEN 2 ELSE 1 END", "o_custkey + 1"
        )
        return self.raw("orders").selectExpr(
            "o_orderkey AS OrderId",
            "o_custkey AS CustomerId",
            f"{address} AS ShippingAddressId",
            "CAST(o_orderkey % 4 AS INT) + 1 AS ChannelId",
            f"CASE WHEN {CANCELLED} THEN 5 WHEN o_orderstatus = 'F' THEN 4"
            " WHEN o_orderstatus = 'O' THEN 3 ELSE 2 END AS StatusId",
            f"{promotion} AS PromotionId",
            "o_orderdate AS OrderDate",
            self.seeded("o_orderkey % 307 = 0", "'WRONG'", code) + " AS PromoCode",
            "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 5.99 END AS DECIMAL(12,2))"
            " AS ShippingAmount",
            "CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.05 AS DECIMAL(12,2)) AS TaxAmount",
        )

    def _sold(self) -> DataFrame:
        prices = self.raw("part").selectExpr(
            "p_partkey", f"{PRICE} AS price", f"{COST} AS UnitCost"
        )
        return self.raw("lineitem").join(prices, F.col("l_partkey") == F.col("p_partkey"))

    def order_items(self) -> DataFrame:
        return self._sold().selectExpr(
            f"{LINE_ID} AS OrderItemId",
            "l_orderkey AS OrderId",
            "l_partkey AS ProductId",
            "CAST(l_quantity AS INT) AS Quantity",
            "CAST(price AS DECIMAL(12,2)) AS UnitPrice",
            "UnitCost",
            f"CAST({QUANTITY} * price * {SHARE_OFF} AS DECIMAL(12,2)) AS DiscountAmount",
        )

    def payments(self) -> DataFrame:
        net = self["order_items"].groupBy("OrderId").agg(
            F.sum(F.expr("Quantity * UnitPrice - DiscountAmount")).alias("Net")
        )
        extra = self.seeded("OrderId % 500 = 0", "0.05", "0.00")
        return (
            self["orders"]
            .join(net, "OrderId")
            .withColumn(
                "attempt",
                F.explode(F.expr("sequence(0, CASE WHEN OrderId % 40 = 0 THEN 1 ELSE 0 END)")),
            )
            .selectExpr(
                "OrderId * 2 + attempt AS PaymentId",
                "OrderId",
                "OrderDate AS PaymentDate",
                f"{_pick(PAYMENT_METHODS, 'OrderId % 5')} AS PaymentMethod",
                "CASE WHEN attempt = 1 THEN 'Failed' WHEN StatusId = 5 THEN 'Refunded'"
                " ELSE 'Captured' END AS PaymentStatus",
                f"CAST(Net + ShippingAmount + TaxAmount + {extra} AS DECIMAL(12,2)) AS Amount",
                "concat('TX', CAST(OrderId * 2 + attempt AS STRING)) AS TransactionRef",
            )
        )

    def shipments(self) -> DataFrame:
        def after(days: str) -> str:
            return f"o_orderdate + make_dt_interval(CAST({days} AS INT))"

        delivered = self.seeded(
            "o_orderkey % 701 = 0", after("o_orderkey % 3"), after("3 + (o_orderkey DIV 5) % 7")
        )
        return self.raw("orders").filter(f"NOT ({CANCELLED})").selectExpr(
            "o_orderkey AS ShipmentId",
            "o_orderkey AS OrderId",
            f"{_pick(CARRIERS, '(o_orderkey DIV 4) % 4')} AS Carrier",
            "concat('TRK', CAST(o_orderkey AS STRING)) AS TrackingNumber",
            f"CASE WHEN o_orderstatus <> 'P' THEN {after('1 + o_orderkey % 3')} END AS ShippedDate",
            "date_add(CAST(o_orderdate AS DATE), CAST(4 + (o_orderkey DIV 3) % 4 AS INT))"
            " AS PromisedDeliveryDate",
            f"CASE WHEN o_orderstatus = 'F' THEN {delivered} END AS DeliveredDate",
            "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit'"
            " ELSE 'Pending' END AS ShippingStatus",
        )

    def returns(self) -> DataFrame:
        handled = _pick(("Requested", "Approved", "Received", "Refunded"), "l_suppkey % 4")
        return self.raw("lineitem").filter(RETURNED).selectExpr(
            f"{LINE_ID} AS ReturnId",
            "l_orderkey AS OrderId",
            "CAST(l_shipdate AS DATE) AS ReturnDate",
            f"{_pick(RETURN_REASONS, 'l_partkey % 6')} AS ReturnReason",
            f"CASE WHEN l_suppkey % 20 = 0 THEN 'Rejected' ELSE {handled} END AS ReturnStatus",
        )

    def return_items(self) -> DataFrame:
        quantity = self.seeded("l_orderkey % 211 = 0", "CAST(l_quantity AS INT) + 1", "1")
        return self._sold().filter(RETURNED).selectExpr(
            f"{LINE_ID} AS ReturnItemId",
            f"{LINE_ID} AS ReturnId",
            f"{LINE_ID} AS OrderItemId",
            f"{quantity} AS ReturnQuantity",
            f"CAST(price - CAST(price * {SHARE_OFF} AS DECIMAL(12,2)) AS DECIMAL(12,2))"
            " AS RefundAmount",
        )

    def product_reviews(self) -> DataFrame:
        delivered = self.raw("orders").filter("o_orderstatus = 'F'")
        rating = "CAST(1 + (l_partkey + l_suppkey) % 5 AS INT)"
        reviewer = self.seeded("l_orderkey % 401 = 0", "o_custkey + 1", "o_custkey")
        return (
            self.raw("lineitem")
            .join(delivered, F.col("l_orderkey") == F.col("o_orderkey"))
            .selectExpr(
                f"{LINE_ID} AS ReviewId",
                f"{reviewer} AS CustomerId",
                "l_partkey AS ProductId",
                f"{LINE_ID} AS OrderItemId",
                "o_orderdate + make_dt_interval(15) AS ReviewDate",
                f"{rating} AS Rating",
                f"concat('Rated ', CAST({rating} AS STRING)) AS ReviewTitle",
                "CAST(NULL AS STRING) AS ReviewText",
                "CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS IsVerifiedPurchase",
                "CAST(l_suppkey % 7 AS INT) AS HelpfulVotes",
            )
        )

    def campaign_interactions(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS InteractionId",
            "1 + CAST(get_json_object(props, '$.k') AS INT) % 18 AS PromotionId",
            "user_id AS CustomerId",
            "ts AS InteractionDate",
            "CASE event_type WHEN 'view' THEN 'Impression' WHEN 'signup' THEN 'Sent'"
            " WHEN 'click' THEN 'Click' WHEN 'purchase' THEN 'Conversion'"
            " ELSE 'Unsubscribe' END AS InteractionType",
            f"{_pick(INTERACTION_CHANNELS, 'event_id % 5')} AS ChannelName",
            "CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN event_id DIV 8 * 12 END"
            " AS OrderId",
        )

    def date_dimension(self) -> DataFrame:
        return order_calendar(self["orders"])


def bind(spark: SparkSession, folder: str, dirty: bool = False) -> StarTables:
    return StarTables(spark, folder, dirty)
