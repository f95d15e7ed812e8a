"""Keys counted table by table: duplicates, missing ones, and references without a parent.

Every table is scanned once, however many keys and references it takes part in
(or, asked so, once per key): its row becomes one small row per role, and all roles are counted in one
aggregate.  References to one parent key share the parent's rows.  Equal keys meet as partial counts, so a key that holds a third of
the rows sends one row per task.  A key of one whole-number column is compared
as a number, any other one as text; one with a NULL in it is missing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderwell.functions.scalars import count_if

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: (table, columns of the key)
UniqueKey = tuple[str, Sequence[str]]
#: (label, child table, child column, parent table, parent column)
Reference = tuple[str, str, str, str, str]
#: So many references to a parent key are counted beside one set of its rows.
TOGETHER = 3


def _whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, WHOLE)


def _role(at: int, slot: int, columns: Sequence[str], number: bool) -> Column:
    """One row's part in a key: the key as number or text, both NULL where it is missing."""
    named = [F.col(f"`{c}`") for c in columns]
    text = named[0].cast("string") if len(named) == 1 else F.to_json(F.struct(*named))
    present = reduce(Column.__and__, [c.isNotNull() for c in named])
    return F.struct(
        F.lit(at).alias("At"),
        F.lit(slot).alias("Slot"),
        (named[0].cast("bigint") if number else F.lit(None).cast("bigint")).alias("Number"),
        (F.lit(None).cast("string") if number else F.when(present, text)).alias("Text"),
    )


def _counted(
    tables: Mapping[str, DataFrame], roles: Mapping[str, list[Column]], keys: int, slots: Mapping[str, int], apart: bool = False
) -> DataFrame:
    """Per key and value: the rows of each slot.  Keys go by number: every value held in memory is a row of its own."""
    scans = [(name, part) for name, listed in roles.items() for part in ([[role] for role in listed] if apart else [listed])]
    parts = [tables[name].select(F.inline(F.array(*part))) for name, part in scans]
    # A key whose tables are empty is reported as well: one row without a value stands for it.
    one = next(iter(tables.values())).sparkSession.range(keys, numPartitions=1)
    parts.append(one.selectExpr("CAST(id AS INT) AS At", "-1 AS Slot", "CAST(NULL AS BIGINT) AS Number", "CAST(NULL AS STRING) AS Text"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("At", "Number", "Text")
        .agg(*[count_if(F.col("Slot") == slot).alias(name) for name, slot in slots.items()])
        .withColumn("Missing", F.col("Number").isNull() & F.col("Text").isNull())
    )


def label_of(key: UniqueKey) -> str:
    """``table.column``, with the columns of a longer key joined by a plus."""
    return f"{key[0]}.{'+'.join(key[1])}"


def _unique(tables: Mapping[str, DataFrame], keys: Iterable[UniqueKey]) -> DataFrame:
    keys = list(dict.fromkeys((name, tuple(columns)) for name, columns in keys))
    roles: dict[str, list[Column]] = {}
    for at, (name, columns) in enumerate(keys):
        number = len(columns) == 1 and _whole(tables[name], columns[0])
        roles.setdefault(name, []).append(_role(at, 0, columns, number))
    labels = F.array(*[F.lit(label_of(key)) for key in keys])
    return _counted(tables, roles, len(keys), {"Parents": 0}).withColumn("Label", F.get(labels, F.col("At")))


def _unique_counts(rows: Column) -> list[Column]:
    """Over the values of a key, each with its number of rows."""
    many = ~F.col("Missing") & (rows > 1)
    return [
        count_if(many).alias("DuplicateValues"),
        F.coalesce(F.sum(F.when(many, rows - 1)), F.lit(0)).alias("SurplusRows"),
        F.sum(F.when(F.col("Missing"), rows).otherwise(0)).alias("NullKeys"),
    ]


def unique_keys(tables: Mapping[str, DataFrame], keys: Iterable[UniqueKey]) -> DataFrame:
    """Per key: values held by more than one row, rows beyond the first of each value, rows without a key."""
    return _unique(tables, keys).groupBy(F.col("Label").alias("CheckName")).agg(*_unique_counts(F.col("Parents")))


def repeated_keys(tables: Mapping[str, DataFrame], keys: Iterable[UniqueKey]) -> DataFrame:
    """The keys themselves that occur more than once: (CheckName, Key, Rows)."""
    return _unique(tables, keys).where(~F.col("Missing") & (F.col("Parents") > 1)).select(
        F.col("Label").alias("CheckName"),
        F.coalesce("Text", F.col("Number").cast("string")).alias("Key"),
        F.col("Parents").alias("Rows"),
    )


def references(tables: Mapping[str, DataFrame], listed: Iterable[Reference]) -> DataFrame:
    """Per reference: parent keys that occur more than once, and child rows whose key has no parent.

    A child without a key refers to nothing and is no orphan.
    """
    return keys_and_references(tables, (), listed).select(
        F.col("Label").alias("Reference"), F.col("DuplicateParents").alias("DuplicateKeys"), "Orphans"
    ).where(F.col("Orphans").isNotNull())


def keys_and_references(
    tables: Mapping[str, DataFrame], keys: Iterable[UniqueKey], listed: Iterable[Reference], apart: bool = False
) -> DataFrame:
    """Unique keys and references in one aggregate, one row for each: (Label, counts of ``unique_keys`` or ``references``).

    The counts a row does not have are NULL.  A key that is the parent or the child of a reference is counted there and
    is not moved a second time.  ``apart`` reads a table once for each key, which suits tables in columnar files: a task
    then holds one key of its rows in memory, not all of them.
    """
    groups: dict[tuple[str, tuple[str, ...], bool, int], list[Reference]] = {}
    met: Counter = Counter()
    for reference in listed:
        _, child, column, parent, key = reference
        number = _whole(tables[child], column) and _whole(tables[parent], key)
        turn = met[parent, key, number] // TOGETHER
        groups.setdefault((parent, (key,), number, turn), []).append(reference)
        met[parent, key, number] += 1
    places: dict[tuple[UniqueKey, bool], tuple[int, int]] = {}
    for at, ((parent, key, number, _), together) in enumerate(groups.items()):
        places.setdefault(((parent, key), number), (at, 0))
        for slot, (_, child, column, _, _) in enumerate(together, 1):
            places.setdefault(((child, (column,)), number), (at, slot))
    wanted = []
    for name, columns in dict.fromkeys((name, tuple(columns)) for name, columns in keys):
        number = len(columns) == 1 and _whole(tables[name], columns[0])
        if ((name, columns), number) not in places:
            places[(name, columns), number] = (len(groups), 0)
            groups[name, columns, number, 0] = []
        wanted.append(((name, columns), *places[(name, columns), number]))

    roles: dict[str, list[Column]] = {}
    found = []
    slots = {"Parents": 0} | {f"Children{slot}": slot for slot in range(1, TOGETHER + 1)}
    nothing = F.lit(None).cast("bigint")

    def result(at: int, label: str, **counts: Column) -> Column:
        named = ("DuplicateValues", "SurplusRows", "NullKeys", "DuplicateParents", "Orphans")
        return F.struct(F.lit(at).alias("Of"), F.lit(label).alias("Label"), *[counts.get(c, nothing).alias(c) for c in named])

    for at, ((parent, key, number, _), together) in enumerate(groups.items()):
        roles.setdefault(parent, []).append(_role(at, 0, key, number))
        for slot, (label, child, column, _, _) in enumerate(together, 1):
            roles.setdefault(child, []).append(_role(at, slot, [column], number))
            counts = {"DuplicateParents": F.get("Unique", F.lit(0)).getField("DuplicateValues"), "Orphans": F.get("Strays", F.lit(slot - 1))}
            found.append(result(at, label, **counts))
    for key, at, slot in wanted:
        counted = F.get("Unique", F.lit(slot))
        found.append(result(at, label_of(key), **{c: counted.getField(c) for c in ("DuplicateValues", "SurplusRows", "NullKeys")}))

    stray = ~F.col("Missing") & (F.col("Parents") == 0)
    counted = _counted(tables, roles, len(groups), slots, apart).groupBy("At").agg(
        F.array(*[F.struct(*_unique_counts(F.col(c))) for c in slots]).alias("Unique"),
        F.array(*[F.coalesce(F.sum(F.when(stray, F.col(c))), F.lit(0)) for c in list(slots)[1:]]).alias("Strays"),
    )
    return counted.select("At", F.inline(F.array(*found))).where(F.col("At") == F.col("Of")).drop("At", "Of")


def many_to_one(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join that ends with an error where ``right`` has two rows of one key.

    The rows of ``right`` are counted by key on the way into the join, in the
    distribution the join needs anyway; there is no pass of its own.  Rows
    without a key meet nothing and are not counted.
    """
    others = [c for c in right.columns if c not in on]
    present = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in on])
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(True)
    counted = right.where(present).groupBy(*on).agg(F.count(F.lit(1)).alias("_ow_rows"), F.first(rest).alias("_ow_rest"))
    message = F.concat(F.lit("more than one row for "), F.to_json(F.struct(*[F.col(f"`{c}`") for c in on])))
    checked = counted.where(F.when(F.col("_ow_rows") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    kept = [F.col(f"`{c}`") for c in on]
    kept += [F.col("_ow_rest").getField(c).alias(c) for c in others]
    return left.join(checked.select(*kept), list(on), how)
