"""Helpers of the pipeline operators: words, Arrow batches of bounded size, hashing."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Texts are handed to a worker function in slices of about this many bytes, or one text.
SLICE_BYTES = 1 << 20

#: Bytes of one Arrow batch between Spark and a Python worker, or one row.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Words are runs of digits, letters and non-ASCII characters; A-Z is lower-cased, the rest parts words.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8; null has none. No character above ASCII parts words."""
    return text.encode().translate(FOLD).split() if text else []


def sha256(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


class WordHash(dict):
    """word -> 64-bit hash, remembered; forgets everything beyond `most` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, many: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, many), np.uint64, len(many))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (multiply and fold, twice)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return values ^ (values >> np.uint64(32))


def give_back() -> None:
    """Return what a task has let go to the system: a worker stays for the next stage, and its peak would stay with it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library that has it
        pass


def bound_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to BATCH_BYTES, unless the session sets a limit of its own.

    Spark's default of 64 MB of long texts is, held by Spark and worker alike, several hundred MB a core.
    """
    spark.conf.set(BATCH_SETTING, spark.conf.get(BATCH_SETTING, str(BATCH_BYTES)))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about `most` bytes of the text column (one row at least)."""
    sizes = np.array([0 if x is None else x for x in pc.binary_length(batch.column(column)).to_pylist()])
    ends, start, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            ends.append((start, i))
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        ends.append((start, batch.num_rows))
    for a, b in ends:
        yield batch.slice(a, b - a)


def arrow_map(
    df: DataFrame,
    setup: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]],
    schema: str,
    text: str = "text",
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Apply a function to slices of rows, of about `most` bytes of `text`.

    `setup` runs once per task and returns a function from a slice to columns; a `_keep` of names passes
    those columns on as they are. No row order or partitioning changes.
    """
    bound_batches(df.sparkSession)
    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(spark_schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for batch in batches:
            for part in slices(batch, text, most):
                got = work(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        got[f.name].cast(f.type)
                        if isinstance(got[f.name], pa.Array)
                        else pa.array(got[f.name], f.type)
                        for f in target
                    ],
                    schema=target,
                )
        del work
        give_back()

    return df.mapInArrow(run, spark_schema)


def change_rows(
    df: DataFrame, setup: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], text: str | None = None
) -> DataFrame:
    """Rows as they are, but for what a function of record batches leaves out or replaces. The columns stay the same.

    `setup` runs once per task. With `text`, the name of a text column, its function gets slices of bounded bytes.
    """
    bound_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for batch in batches:
            for part in slices(batch, text) if text else [batch]:
                yield work(part)
        del work
        give_back()

    return df.mapInArrow(run, df.schema)


def by_place(df: DataFrame) -> DataFrame:
    """The columns named c0, c1, ... so that no added name clashes with one of theirs."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


