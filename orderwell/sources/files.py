"""Reading contracted CSV sources and writing the reporting export."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwell.session import materialize, shuffles_released
from orderwell.sources.contracts import CONTRACTS, SourceError

# Parents before children, so that a failed load leaves no dangling keys.
LOAD_ORDER = (
    "customer_segments", "sales_channels", "order_statuses", "categories", "date_dimension",
    "promotions", "customers", "addresses", "products", "orders", "order_items", "payments",
    "shipments", "returns", "return_items", "product_reviews", "campaign_interactions",
)


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.csv"


#: Fields in double quotes may hold commas, doubled quotes and line breaks.
QUOTED = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}
TIME = "yyyy-MM-dd['T'][ ]HH:mm:ss"
BAD = "_record"
MANIFEST = "export_manifest"


def _header(spark: SparkSession, folder: str, name: str) -> list[str]:
    contract = CONTRACTS[name]
    try:
        header = spark.read.options(**QUOTED).csv(_path(folder, name)).columns
    except AnalysisException as error:
        raise FileNotFoundError(f"source table is missing: {_path(folder, name)}") from error
    missing = sorted(set(contract.in_file) - set(header))
    if missing:
        raise SourceError(f"{name} lacks required columns: {missing}")
    return header


def _scan(
    spark: SparkSession, folder: str, name: str, header: list[str], mode: str, line_breaks: bool
) -> DataFrame:
    """The columns of the files, typed as declared.  Every file's own header is held against the first one's."""
    types = {field.name: field.dataType for field in CONTRACTS[name].schema}
    # Every column is read as written in the file, then cast where declared.
    layout = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    if mode == "PERMISSIVE":
        layout = layout.add(BAD, T.StringType())
    return (
        spark.read.schema(layout)
        .options(**QUOTED)
        .option("multiLine", line_breaks)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", BAD)
        .option("timestampNTZFormat", TIME)
        .csv(_path(folder, name))
    )


def _declared(data: DataFrame, name: str, header: list[str]) -> DataFrame:
    return data.select(
        *[
            F.col(field.name)
            if field.name in header
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in CONTRACTS[name].schema
        ]
    )


def read_table(
    spark: SparkSession, folder: str, name: str, line_breaks: bool = True
) -> DataFrame:
    """One CSV table under its contract; a record that does not parse is an error.

    The header decides which file column is which; columns outside the contract
    are dropped, a missing NOT NULL column is an error, and a missing optional
    one is NULL.  Values take the contract's types; an empty string is NULL.
    Without ``line_breaks`` in fields, large files are split among tasks.
    """
    header = _header(spark, folder, name)
    return _declared(_scan(spark, folder, name, header, "FAILFAST", line_breaks), name, header)


def read_with_rejects(
    spark: SparkSession, folder: str, name: str, line_breaks: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows that parse, and the records that do not: (TableName, Record, MissingKey).

    A record is rejected if a value has not its declared type, if it has too
    many or too few fields, or if its key is missing.  The files are parsed once,
    into a table of the shared folder, from which both results are read.
    """
    header = _header(spark, folder, name)
    parsed = _scan(spark, folder, name, header, "PERMISSIVE", line_breaks)
    key = CONTRACTS[name].key
    written = materialize(parsed.withColumn("_keyless", F.col(BAD).isNull() & F.col(key).isNull()))
    bad = F.col(BAD).isNotNull() | F.col("_keyless")
    rejects = written.where(bad).select(
        F.lit(name).alias("TableName"),
        F.coalesce(F.col(BAD), F.to_json(F.struct(*[F.col(f"`{c}`") for c in header]))).alias("Record"),
        F.col("_keyless").alias("MissingKey"),
    )
    return _declared(written.where(~bad), name, header), rejects


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seventeen tables.  Large facts are split by the scan, not by hand."""
    return {name: read_table(spark, folder, name) for name in CONTRACTS}


def load_typed(spark: SparkSession, folder: str, target: str) -> dict[str, DataFrame]:
    """Full replace of the typed tables from CSV, parents first."""
    for name in LOAD_ORDER:
        read_table(spark, folder, name).write.mode("overwrite").parquet(f"{target}/{name}")
    return read_typed(spark, target)


def read_typed(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(contract.schema).parquet(f"{target}/{name}")
        for name, contract in CONTRACTS.items()
    }


def six_decimals(df: DataFrame) -> DataFrame:
    """Presentation form: fractions with six decimals, times to the second."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = column.cast("decimal(28,6)")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("decimal(28,6)")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as files that ``read_table`` reads back as it was, whatever its texts hold."""
    df.write.mode("overwrite").options(**QUOTED).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def _content(df: DataFrame) -> Column:
    """Sum of a 64-bit hash of every row: no order, and two equal rows do not cancel out.

    Values are compared as text, NULL and empty text alike, so that a CSV file
    and the table it was written from agree.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("string")


def _presented(df: DataFrame) -> DataFrame:
    """The cells of a CSV file."""
    shown = six_decimals(df)
    return shown.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in shown.columns])


def _exported(spark: SparkSession, path: str, as_csv: bool) -> DataFrame:
    return spark.read.options(**QUOTED).option("multiLine", True).csv(path) if as_csv else spark.read.parquet(path)


def export_star(
    star: Mapping[str, DataFrame],
    folder: str,
    as_csv: bool = False,
    only: Iterable[str] | None = None,
    run: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write the 22 reporting tables in key order and return what was written.

    A fact is written once as it is built and sorted from there, so that the
    disks hold what building it has shuffled, or what sorting it does, not both.
    What several facts read (accepted returns, order totals) is written once.
    Parquet keeps full precision; CSV gets the presentation form.  Rows and a
    content check of each table are taken while it is written, without a second
    read.  They go, with the run's own facts (``run``: snapshot date, settings),
    into the folder's manifest, which is written last: after an export that
    broke off, ``changed_files`` names the tables that are not as it says.
    ``only`` chooses files by name.
    """
    from orderwell.operators.facts import SharedOrders
    from orderwell.plans.star import EXPORTS, Star

    spark = next(iter(star.values())).sparkSession
    if isinstance(star, Star):
        star = Star(SharedOrders(star.t))
    chosen = set(only) if only is not None else {file for file, _, _ in EXPORTS}
    unknown = chosen - {file for file, _, _ in EXPORTS}
    if unknown:
        raise ValueError(f"no such export: {', '.join(sorted(unknown))}")
    facts = json.dumps(dict(run or {}), sort_keys=True)
    lines = []
    for file, table, keys in EXPORTS:
        if file not in chosen:
            continue
        ordered = (materialize(star[table]) if table.startswith("Fact") else star[table]).orderBy(*keys)
        shown = _presented(ordered) if as_csv else ordered
        seen = Observation()
        watched = shown.observe(seen, F.count(F.lit(1)).alias("Rows"), _content(shown).alias("Content"))
        path = f"{folder.rstrip('/')}/{file}"
        with shuffles_released(spark):
            if as_csv:
                watched.write.mode("overwrite").options(**QUOTED).csv(path)
            else:
                watched.write.mode("overwrite").parquet(path)
        lines.append((file, seen.get["Rows"], seen.get["Content"], "csv" if as_csv else "parquet", facts))
    manifest = spark.createDataFrame(lines, "TableName string, Rows bigint, Content string, Format string, Run string")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    return manifest


def changed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Exported tables whose files no longer hold what the folder's manifest says."""
    stored = spark.read.parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    parts = []
    for line in stored.collect():  # one line per exported table
        df = _exported(spark, f"{folder.rstrip('/')}/{line['TableName']}", line["Format"] == "csv")
        parts.append(
            df.agg(F.lit(line["TableName"]).alias("TableName"), F.count(F.lit(1)).alias("Rows"), _content(df).alias("Content"))
        )
    return changed_tables(stored.select("TableName", "Rows", "Content"), reduce(DataFrame.unionByName, parts))


def read_export(
    spark: SparkSession, folder: str, star: Mapping[str, DataFrame], only: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """CSV export read back with the type of every column declared; ``only`` chooses files by name."""
    from orderwell.plans.star import EXPORTS

    return {
        table: spark.read.schema(star[table].schema)
        .options(**QUOTED)
        .option("multiLine", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(f"{folder.rstrip('/')}/{file}")
        for file, table, _ in EXPORTS
        if only is None or file in only
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run metadata: (TableName, Rows)."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("Rows"))
            for name, df in tables.items()
        ],
    )


def manifest(tables: Mapping[str, DataFrame], names: Iterable[str] | None = None) -> DataFrame:
    """Rows and a content check per table that ignores row order.

    The check sums a 64-bit hash of every row as a decimal: unlike XOR, a sum
    does not let two equal rows cancel out.
    """
    parts = []
    for name in names or tables:
        df = tables[name]
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
        parts.append(
            df.agg(
                F.lit(name).alias("TableName"),
                F.count(F.lit(1)).alias("Rows"),
                F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("Content"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def changed_tables(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables whose rows or content differ from a stored manifest."""
    renamed = actual.withColumnsRenamed({"Rows": "ActualRows", "Content": "ActualContent"})
    return expected.join(renamed, "TableName", "full").filter(
        ~F.col("Rows").eqNullSafe(F.col("ActualRows"))
        | ~F.col("Content").eqNullSafe(F.col("ActualContent"))
    )
