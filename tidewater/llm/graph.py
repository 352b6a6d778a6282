"""Connected components by alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b): root is the component's smallest node.

    Each step is two joins on tables in the shared folder, about log(n) of them
    for n nodes; no component is ever gathered in one task. An empty table of
    edges gives no rows.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: every larger neighbour is hung on the smallest one.
        large = saved(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large")
        # Small star: a node and its smaller neighbours are hung on the smallest one.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = saved(small.filter("a <> b").distinct(), "small")
        if (new := _state(now)) == state:
            break
        state = new
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
