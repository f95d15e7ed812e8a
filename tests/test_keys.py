"""Keys and references counted table by table."""

import random
from collections import Counter

import pytest

from orderwell.quality import report
from orderwell.quality.checks import declared_keys
from orderwell.quality.keys import many_to_one, references, repeated_keys, unique_keys
from orderwell.sources.contracts import SourceError
from shop import shop, table, when


@pytest.fixture(scope="module")
def random_tables(spark):
    """A child and a parent table with missing, repeated and stray keys; one key holds a third of the rows."""
    rng = random.Random(5)

    def key():
        return rng.choice([7, 7, None, rng.randrange(40)])

    child = [(key(), rng.choice("ab"), key()) for _ in range(600)]
    parent = [(rng.choice([None, *range(30)]), str(rng.randrange(30))) for _ in range(60)]
    tables = {
        "child": spark.createDataFrame(child, "k int, s string, `odd name` bigint").repartition(7),
        "parent": spark.createDataFrame(parent, "id bigint, code string"),
        "empty": spark.createDataFrame([], "id bigint"),
    }
    return tables, child, parent


def test_unique_keys_equal_a_plain_count(random_tables):
    tables, child, parent = random_tables
    wanted = {
        "child.k": [r[0] for r in child],
        "child.s+k": [(r[1], r[0]) if r[0] is not None else None for r in child],
        "child.odd name": [r[2] for r in child],
        "parent.code": [r[1] for r in parent],
        "empty.id": [],
    }
    keys = [("child", ("k",)), ("child", ("s", "k")), ("child", ("odd name",)), ("parent", ("code",)), ("empty", ("id",))]
    got = {r["CheckName"]: (r["DuplicateValues"], r["SurplusRows"], r["NullKeys"]) for r in unique_keys(tables, keys).collect()}
    for label, values in wanted.items():
        counts = Counter(v for v in values if v is not None)
        many = [n for n in counts.values() if n > 1]
        assert got.pop(label) == (len(many), sum(many) - len(many), values.count(None)), label
    assert not got
    found = repeated_keys(tables, [("child", ("k",))]).collect()
    assert {(r["Key"], r["Rows"]) for r in found} == {(str(k), n) for k, n in Counter(r[0] for r in child).items() if n > 1 and k is not None}


def test_references_equal_a_plain_count(random_tables):
    tables, child, parent = random_tables
    listed = [
        ("number", "child", "k", "parent", "id"),  # int against bigint
        ("text", "child", "odd name", "parent", "code"),  # number against text
        ("nothing", "child", "k", "empty", "id"),
        ("itself", "parent", "id", "parent", "id"),
    ]
    got = {r["Reference"]: (r["DuplicateKeys"], r["Orphans"]) for r in references(tables, listed).collect()}

    def plain(children, parents):
        counts = Counter(p for p in parents if p is not None)
        return sum(n > 1 for n in counts.values()), sum(c is not None and c not in counts for c in children)

    ids = [r[0] for r in parent]
    assert got == {
        "number": plain([r[0] for r in child], ids),
        "text": plain([None if r[2] is None else str(r[2]) for r in child], [r[1] for r in parent]),
        "nothing": plain([r[0] for r in child], []),
        "itself": plain(ids, ids),
    }


def test_each_table_is_scanned_once(spark, tmp_path, random_tables):
    tables = {}
    for name, df in random_tables[0].items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    counted = references(tables, [("a", "child", "k", "parent", "id"), ("b", "child", "odd name", "parent", "id"), ("c", "parent", "id", "child", "k")])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan and "Python" not in plan


def test_many_to_one_join_ends_at_a_second_row(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (2, None, 12), (3, "c", 13)], "k int, s string, v int")
    right = [(1, "a", "x", None), (2, None, "y", 1), (2, None, "z", 2), (9, "q", "w", 3)]
    schema = "k int, s string, name string, n int"
    joined = many_to_one(left, spark.createDataFrame(right, schema), ["k", "s"], "left")
    assert joined.columns == ["k", "s", "v", "name", "n"]
    assert {(r["v"], r["name"]) for r in joined.collect()} == {(10, "x"), (11, "x"), (12, None), (13, None)}
    twice = spark.createDataFrame([*right, (1, "a", "again", 5)], schema)
    with pytest.raises(Exception, match="more than one row for"):
        many_to_one(left, twice, ["k", "s"]).collect()


def test_second_shipment_and_second_review_are_reported(spark):
    orders = [dict(OrderId=i, OrderDate=when("2024-03-01")) for i in (1, 2)]
    items = [dict(OrderItemId=i, OrderId=i) for i in (1, 2)]
    sent = [dict(ShipmentId=i, OrderId=max(1, i - 1), TrackingNumber=f"T{i}") for i in (1, 2, 3)]
    said = [dict(ReviewId=i, OrderItemId=1) for i in (1, 2, 3)]
    t = shop(spark, orders=orders, order_items=items, shipments=sent, product_reviews=said)
    got = {r["CheckName"]: (r["DuplicateValues"], r["SurplusRows"]) for r in declared_keys(t).collect()}
    assert got.pop("shipments.OrderId") == (1, 1) and got.pop("product_reviews.OrderItemId") == (1, 2)
    assert set(got.values()) == {(0, 0)}
    with pytest.raises(SourceError, match="unique:shipments.OrderId"):
        report.require_quality(report.quality_report(t))
    one_each = {**t, "shipments": table(spark, "shipments", sent[1:])}
    failed = report.quality_report(one_each).where("Status = 'FAIL' AND CheckName LIKE 'unique:%'").collect()
    assert [(r["CheckName"], r["Blocking"]) for r in failed] == [("unique:product_reviews.OrderItemId", 0)]


def test_references_to_one_parent_share_its_rows(random_tables):
    """Five references to one key, of two groups, count as each alone does, with two sets of parent rows."""
    tables, _, _ = random_tables
    listed = [(f"r{i}", "child", ("k", "odd name")[i % 2], "parent", "id") for i in range(5)]
    together = {tuple(r) for r in references(tables, listed).collect()}
    assert together == {tuple(r) for one in listed for r in references(tables, [one]).collect()}
    plan = references(tables, listed)._jdf.queryExecution().optimizedPlan().toString()
    parents = next(row for row in plan.splitlines() if "Generate inline" in row and "id#" in row)
    assert parents.count("struct(At") == 2
