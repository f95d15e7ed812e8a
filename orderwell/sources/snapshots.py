"""Stored snapshots, one partition per snapshot day."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.sources.contracts import SourceError


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Replace only the days present in ``snapshot``; the commit is atomic per job."""
    (
        snapshot.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("SnapshotDate")
        .parquet(path)
    )


def read_snapshot(
    spark: SparkSession, path: str, day: dt.date | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """One day, or the latest one, or the latest one up to ``as_of``: a scalar subquery that prunes partitions."""
    stored = spark.read.parquet(path).withColumn(
        "SnapshotDate", F.col("SnapshotDate").cast("date")
    )
    if day is not None:
        return stored.filter(F.col("SnapshotDate") == F.lit(day))
    known = stored if as_of is None else stored.filter(F.col("SnapshotDate") <= F.lit(as_of))
    return stored.filter(F.col("SnapshotDate") == known.agg(F.max("SnapshotDate")).scalar())


# Overwriting a partition takes the old files away before the new ones are in place.  Where readers come at any time,
# every write keeps a folder of its own, and a day changes with the one line that names its folder.


def publish_snapshot(snapshot: DataFrame, path: str) -> None:
    """Replace the days present in ``snapshot`` for all readers at once.

    The rows go to a new folder; then one file of lines (day, folder, rows) is
    added to the store's commits.  A write that breaks off before leaves the
    store as it was, and a reader who has begun keeps the files it has begun with.
    """
    run = uuid.uuid4().hex
    target = f"{path.rstrip('/')}/runs/{run}"
    dated = snapshot.withColumn("SnapshotDate", F.col("SnapshotDate").cast("date"))
    dated.write.partitionBy("SnapshotDate").parquet(target)
    written = snapshot.sparkSession.read.schema(dated.schema).parquet(target)
    if not written.where(F.col("SnapshotDate").isNull()).isEmpty():  # one partition of what was written
        raise SourceError("a snapshot needs a SnapshotDate in every row")
    lines = written.groupBy("SnapshotDate").agg(F.count(F.lit(1)).alias("Rows")).select(
        "SnapshotDate", F.lit(run).alias("Run"), "Rows", F.current_timestamp().alias("CommittedAt")
    )
    lines.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/commits")


def published_days(spark: SparkSession, path: str) -> DataFrame:
    """The line that counts for each day: the one committed last."""
    newest = F.struct("CommittedAt", "Run", "Rows")
    return (
        spark.read.parquet(f"{path.rstrip('/')}/commits")
        .groupBy("SnapshotDate")
        .agg(F.max(newest).alias("last"))
        .select("SnapshotDate", "last.Run", "last.Rows", "last.CommittedAt")
    )


def read_published(
    spark: SparkSession, path: str, day: dt.date | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """One day, the latest one, or the latest one up to ``as_of``; only that day's files are listed and read."""
    days = published_days(spark, path)
    if day is not None:
        days = days.where(F.col("SnapshotDate") == F.lit(day))
    if as_of is not None:
        days = days.where(F.col("SnapshotDate") <= F.lit(as_of))
    line = days.orderBy(F.col("SnapshotDate").desc()).first()
    if line is None:
        raise SourceError(f"no snapshot of {day or as_of or 'any day'} in {path}")
    run = f"{path.rstrip('/')}/runs/{line['Run']}"
    stored = spark.read.option("basePath", run).parquet(f"{run}/SnapshotDate={line['SnapshotDate']}")
    return stored.withColumn("SnapshotDate", F.col("SnapshotDate").cast("date"))


def superseded_runs(spark: SparkSession, path: str) -> DataFrame:
    """Folders that no day is read from any more; they can be removed once no reader is left in them."""
    current = published_days(spark, path).select("Run")
    return spark.read.parquet(f"{path.rstrip('/')}/commits").select("Run").distinct().join(current, "Run", "left_anti")


def latest_segment_summary(spark: SparkSession, path: str) -> DataFrame:
    from orderwell.functions import ratio

    return (
        read_snapshot(spark, path)
        .groupBy("SnapshotDate", "Segment")
        .agg(
            F.count(F.lit(1)).alias("Customers"),
            ratio(F.sum("RecencyDays"), F.count("RecencyDays")).alias("AvgRecencyDays"),
            ratio(F.sum("Frequency"), F.count("Frequency")).alias("AvgFrequency"),
            F.sum("MonetaryValue").alias("SegmentValue"),
        )
        .orderBy(F.col("SegmentValue").desc(), "Segment")
    )
