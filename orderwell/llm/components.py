"""Connected components of an edge table, by rounds of joins; nothing is gathered on the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node in it) for every node of an edge; null ends and loops give no edge.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then every
    node links its smaller neighbours to the smallest. Each step only aggregates by node and joins the result back, so
    the two sides of a hot node are joined by rows that adaptive execution can split. Rounds grow with the logarithm of
    the longest path.
    """
    edges = materialize(
        edges.where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct()
    )
    while True:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        # larger neighbours of v move to its smallest neighbour (itself included)
        large = both.where(F.col("u") > F.col("v")).join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = materialize(large.distinct())
        # v and its smaller neighbours move to the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v != u")
        new = materialize(small.unionByName(low.select("v", F.col("m").alias("u"))).distinct())
        # a star forest: each node has one smaller neighbour, which is nobody's larger one
        counts = new.agg(F.count("*"), F.count_distinct("v")).first()
        settled = counts[0] == counts[1] and new.join(new.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
        edges = new
        if settled:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
