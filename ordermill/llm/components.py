"""Connected components of an edge list, as alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` (longs); root = smallest node reachable.

    Each round points the larger neighbours of a node at its smallest one,
    then does the same among smaller neighbours; rounds grow with the
    logarithm of the longest path.  Every round is a written table; minima
    are partly aggregated before the shuffle and hot centres meet only in
    joins, which AQE splits."""
    e = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        e = staged(small, "edges")
        # a fixed point is a forest of stars: nobody is both a child and a root
        new = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
