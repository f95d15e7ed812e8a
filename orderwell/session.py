"""Session settings the library is tuned for, and the one way it cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that do not depend on the size of the cluster.  Shuffle width is left
# to adaptive coalescing: start wide, let AQE merge small partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "orderwell", master: str | None = None, **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is set, a session whose executors run inside the driver gets a
    local folder, which goes when the program ends.  On a cluster that folder
    would be another one on every machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.TemporaryDirectory(prefix="orderwell-")
    return _LOCAL_FOLDERS[context.applicationId].name


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, what a write has shuffled leaves the disks when the write ends, not when the driver collects its garbage.

    A write plans its table anew, so nothing reads those files again.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def materialize(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    A written table survives the loss of an executor and is computed exactly
    once, which ``checkpoint()`` alone does not promise.  ``rows_per_file`` (0:
    as the session has it) bounds the rows that a task reads, as it opens a
    bounded number of files.  What the write has shuffled is gone afterwards.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/orderwell/{uuid.uuid4().hex}"
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    with shuffles_released(df.sparkSession):
        writer.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)


class Stored(Mapping):
    """Tables of which the named ones are written once, when first asked for, and read from there afterwards.

    For a caller that scans them many times: what it takes to build a table (joins, sums) is then done once.
    """

    def __init__(self, tables: Mapping[str, DataFrame], names: Collection[str]):
        self.tables, self.names = tables, frozenset(names)
        self._written: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            return self.tables[name]
        if name not in self._written:
            self._written[name] = materialize(self.tables[name])
        return self._written[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)
