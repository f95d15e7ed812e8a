"""Every checked query: Spark function, output columns, and reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwell.sources.star_binding import bind
from oracle.prelude import with_clause

TYPES = {
    "i": ("bigint", "BIGINT"),
    "f": ("double", "DOUBLE"),
    "d": ("date", "DATE"),
    "s": ("string", "VARCHAR"),
    "t": ("timestamp_ntz", "TIMESTAMP"),
}


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    build: Callable[[dict[str, DataFrame]], DataFrame]
    needs: str
    sql: str
    dirty: bool = False

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        result = self.build(bind(spark, folder, dirty=self.dirty))
        return result.select(*[F.col(c).cast(TYPES[k][0]).alias(c) for c, k in self.columns])

    def reference(self) -> str:
        cast = ", ".join(f"CAST({c} AS {TYPES[k][1]}) AS {c}" for c, k in self.columns)
        return f"{with_clause(self.needs)}SELECT {cast} FROM (\n{self.sql.strip()}\n) AS result"


QUERIES: dict[str, Query] = {}


def query(
    name: str, columns: str, needs: str, sql: str, dirty: bool = False
) -> Callable[[Callable], Callable]:
    """Register a function of the bound tables under a driver key.

    ``columns`` lists name:type pairs; one-letter groups such as ``i: A B`` set
    the type of the names after them.
    """

    def register(build: Callable) -> Callable:
        listed, kind = [], "s"
        for word in columns.split():
            if word.endswith(":") and word[:-1] in TYPES:
                kind = word[:-1]
            else:
                listed.append((word, kind))
        QUERIES[name] = Query(name, tuple(listed), build, needs, sql, dirty)
        return build

    return register
