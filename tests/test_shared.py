"""What several checks or findings read is built once, with the same results."""

import time

import pytest
from pyspark.sql import functions as F

from orderwell.functions import date_key
from orderwell.operators.facts import ORDER_LINE_COLUMNS, SharedOrders, accepted_returns, line_facts, order_facts, order_lines
from orderwell.operators.insights import insights
from orderwell.plans import pages
from orderwell.plans.measures import evaluate
from orderwell.plans.star import Star
from orderwell.quality import report
from orderwell.quality.keys import keys_and_references, references, unique_keys
from orderwell.session import RELEASE, materialize
from orderwell.sources import files
from shop import shop, when


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def small_shop(spark):
    """Three orders, one of them twice and one cancelled, with returned, rejected and missing lines."""
    orders = [dict(OrderId=i, OrderDate=when(f"2024-0{i}-01"), StatusId=5 if i == 3 else 4) for i in (1, 2, 2, 3)]
    items = [dict(OrderItemId=i, OrderId=i % 3 + 1) for i in range(1, 7)]
    returns = [dict(ReturnId=i, OrderId=i, ReturnStatus="Rejected" if i == 2 else "Approved") for i in (1, 2, 3)]
    lines = [dict(ReturnItemId=i, ReturnId=i % 3 + 1, OrderItemId=i) for i in (1, 2, 2, 3)]
    reviews = [dict(ReviewId=i, OrderItemId=i) for i in (1, 2, 3, 9)]
    return shop(spark, orders=orders, order_items=items, returns=returns, return_items=lines, product_reviews=reviews)


def same(a, b):
    columns = sorted(b.columns)
    assert sorted(a.columns) == columns
    assert sorted(map(repr, a.select(columns).collect())) == sorted(map(repr, b.select(columns).collect()))


def test_shared_order_facts_are_the_order_facts(spark):
    t = small_shop(spark)
    shared = SharedOrders(t)
    for asked in ({}, {"only_valid": True}, {"repeat": True, "shipment": True}, {"sequence": True}, {"segment": True, "geography": True, "promotion": True}):
        same(order_facts(shared, **asked), order_facts(t, **asked))
    same(line_facts(shared), line_facts(t))
    same(accepted_returns(shared), accepted_returns(t).select("OrderItemId", "ReturnQuantity", "RefundAmount", "OrderId"))
    assert "Aggregate" in plan_of(order_facts(t)) and "Aggregate" not in plan_of(order_facts(shared))


def marked(t, name):
    """The table, with a join that shows in every plan that builds it."""
    mark = t[name].sparkSession.range(1).select(F.lit(1).alias("one"), F.rand(1).alias(f"built_{name}"))
    return {**t, name: t[name].join(mark, F.col(f"built_{name}") < 2).drop("one")}


def test_report_builds_lines_once(spark):
    """q21: the report reads lines from where they were written, and has the counts it had."""
    t = small_shop(spark)
    counted = report.quality_report(marked(t, "order_items"))
    assert "rand(1)" not in plan_of(counted)
    assert "Aggregate" not in plan_of(counted)  # each check's counts are written, what it has shuffled is gone
    found = {r["CheckName"]: r["Violations"] for r in counted.collect()}
    assert len(found) == counted.count()
    assert found["duplicate_key:orders.OrderId"] == 1 and found["duplicate_key:return_items.ReturnItemId"] == 1
    assert found["unique:return_items.ReturnId+OrderItemId"] == 1 and found["unique:product_reviews.OrderItemId"] == 0
    assert found["foreign_key:product_reviews.OrderItemId"] == 1 and found["foreign_key:return_items.OrderItemId"] == 0
    assert found["null_key:orders.OrderId"] == 0


def test_insights_build_order_totals_once(spark):
    """m41: lines are summed by order in one place; the findings read the sums."""
    t = small_shop(spark)
    assert "rand(1)" not in plan_of(insights(marked(t, "order_items")))


def test_keys_and_references_together(spark):
    """A key that is also a parent or a child is counted there: as alone, and moved once."""
    t = {
        "parent": spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "c"), (None, None)], "id int, code string"),
        "child": spark.createDataFrame([(1, "a"), (1, "x"), (3, "x"), (None, "x"), (None, None)], "id bigint, code string"),
    }
    listed = [("id", "child", "id", "parent", "id"), ("code", "child", "code", "parent", "code"), ("mixed", "child", "id", "parent", "code")]
    keys = [(name, (c,)) for name in t for c in ("id", "code")] + [("child", ("id", "code"))]
    both = keys_and_references(t, keys, listed)
    got = {tuple(r) for r in both.where("NullKeys IS NOT NULL").select("Label", "DuplicateValues", "SurplusRows", "NullKeys").collect()}
    assert got == {tuple(r) for r in unique_keys(t, keys).collect()}
    assert sorted(map(repr, keys_and_references(t, keys, listed, apart=True).collect())) == sorted(map(repr, both.collect()))
    got = {tuple(r) for r in both.where("Orphans IS NOT NULL").select("Label", "DuplicateParents", "Orphans").collect()}
    assert got == {tuple(r) for r in references(t, listed).collect()} == {("id", 1, 1), ("code", 1, 3), ("mixed", 1, 3)}


def test_reviews_meet_no_returns_unless_asked(spark):
    """x21t: ratings need no returns; the rows of reviews are the same."""
    star = Star(small_shop(spark))
    slim = star.rows("FactReviews", {"Rating", "ProductId"})
    assert "Join" not in plan_of(slim)
    columns = ["ReviewId", "ReviewDateKey", "ProductId", "Rating"]
    same(slim.select(columns), star["FactReviews"].select(columns))
    assert "WasReturned" in star.rows("FactReviews", {"WasReturned"}).columns


def test_review_measures_bring_the_returns_they_need(spark):
    """x09: the rate of returned reviews finds its flag, alone or beside other measures, by product."""
    star = Star(small_shop(spark))
    by = [("DimProduct", "ProductId")]
    # lines 2 and 3 have an accepted return, line 1 a rejected one, line 9 none
    found = evaluate(star, ["Reviews", "Average Rating", "Reviewed Item Return Rate"], by).collect()
    assert [tuple(r) for r in found] == [(1, 4, 5.0, 0.5)]
    assert [tuple(r) for r in evaluate(star, ["Returned Reviews"]).collect()] == [(2,)]


def test_returned_reviews_by_rating(spark):
    """x21s: a group of the fact itself, and the flag beside it."""
    t = small_shop(spark)
    rated = t["product_reviews"].withColumn("Rating", F.when(F.col("ReviewId") == "2", 1).otherwise(4))
    found = pages.rating_behavior(Star({**t, "product_reviews": rated})).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1.0), (4, 3, 1 / 3)]


def shuffles(spark):
    """Ids of the shuffles whose files the session holds."""
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet()
    return {int(i) for i in held.mkString(",").split(",") if i}


def left_behind(spark, run):
    """The shuffles of ``run`` that are still held after it; they are let go in the background."""
    before = shuffles(spark)
    result = run()
    for _ in range(50):
        left = shuffles(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return result, left


def test_a_write_leaves_no_shuffle_files(spark):
    """The setting that lets them go is as it was afterwards, also where the write failed."""
    summed = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    before = spark.conf.get(RELEASE, None)
    written, left = left_behind(spark, lambda: materialize(summed))
    assert not left and spark.conf.get(RELEASE, None) == before
    same(written, summed)
    with pytest.raises(Exception):
        materialize(summed.select(F.raise_error(F.lit("no")).alias("x")))
    assert spark.conf.get(RELEASE, None) == before


@pytest.mark.parametrize("as_csv", [True, False])
def test_export_leaves_no_shuffle_files(spark, tmp_path, as_csv):
    """s05: facts are written before they are sorted; the files hold what the star holds, in order."""
    star = Star(small_shop(spark))
    only = ["fact_orders", "fact_order_lines", "fact_returns", "fact_reviews"]
    written, left = left_behind(spark, lambda: files.export_star(star, str(tmp_path), as_csv, only=only))
    assert not left and {r["TableName"]: r["Rows"] for r in written.collect()} == dict(zip(only, (4, 8, 5, 4)))
    assert files.changed_files(spark, str(tmp_path)).count() == 0
    if not as_csv:
        for name, table in (("fact_orders", "FactOrders"), ("fact_order_lines", "FactOrderLines"), ("fact_reviews", "FactReviews")):
            same(spark.read.parquet(f"{tmp_path}/{name}"), star[table])
        keys = [r[0] for r in spark.read.parquet(f"{tmp_path}/fact_order_lines").select("OrderItemId").collect()]
        assert keys == sorted(keys)


def test_order_lines_move_with_the_id_of_their_category(spark):
    """m01: names of categories meet lines that have met their orders; the rows are those of line facts."""
    t = small_shop(spark)
    top = plan_of(order_lines({**t, "categories": t["categories"].where(F.rand(1) < 2)}))
    joins = [line for line in top.splitlines() if "Join" in line]
    assert "CategoryId" in joins[0] and "OrderId" in joins[1]
    facts = line_facts(t, customer=True, geography=True, product=True, promotion=True)
    whole = facts.withColumn("OrderDateKey", date_key("OrderDate")).select(*ORDER_LINE_COLUMNS)
    same(order_lines(t), whole)
    assert whole.count() == 8
