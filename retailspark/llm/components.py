"""Connected components over edge tables, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailspark.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours point to the least node among it and them: the greater neighbours (large star), or the
    lesser ones and the node itself (small star)."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    pointed = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return pointed.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node on an edge (a, b); the label is the component's least node.

    The steps end when nothing changes, after about the logarithm of the longest path's length. Each pair of steps is
    written, so that no lineage grows. Self-edges and repeated edges do no harm; no edges give no rows.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        now = staged(_star(_star(now, True), False), "stars")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if seen == state:
            break
        state = seen
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots.distinct())
