"""Connected components by alternating star contractions on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetick.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Re-hang neighbours on the smallest node around.

    Large star: every larger neighbour of u. Small star: u itself and every smaller neighbour.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    around = both if large else both.filter(F.col("v") < F.col("u"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    if large:
        moved = around.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = around.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, root``: the smallest id of every node's component.

    ``edges``: ``a, b``; ``nodes``: ``id``. Rounds grow with the logarithm of the graph, and every
    round is written to the shared folder, so a lost executor only repeats its own round.
    """
    current = stage(edges.filter(F.col("a") != F.col("b")).distinct())
    seen = None
    while True:
        current = stage(_star(_star(current, large=True), large=False))
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = current.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
