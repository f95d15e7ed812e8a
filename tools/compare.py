"""Run queries in Spark and their reference SQL in DuckDB, and compare all values.

Usage: python tools/compare.py FOLDER [NAME_PREFIX ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from orderwell.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def compare(spark, con, query, folder):
    result = query.run(spark, folder)
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    relation = con.sql(query.reference())
    want = rows_of(relation.columns, relation.fetchall())
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {result.columns} / {relation.columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    names = sorted(result.columns)
    for g, w in zip(got, want):
        if g != w:
            return "first difference " + str(
                [(n, a, b) for n, a, b in zip(names, g, w) if a != b][:5]
            ) + f" in {g[:6]}"
    return None if got else "no rows"


def main() -> int:
    from oracle import load_all

    folder, prefixes = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name, query in load_all().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
