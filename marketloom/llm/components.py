"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest node among them and itself: the
    larger neighbours (large star), or the smaller ones and the node (small star)."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(back) if large else edges.unionByName(back).filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.filter("b > a") if large else both.unionByName(both.select("a", F.col("a").alias("b")))
    return moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of the edges (longs); label is the smallest node.

    Alternating large and small stars; each round is stored in the shared folder, and the
    rounds needed grow with the logarithm of the longest path.  Minima combine before the
    shuffle, so a node with very many neighbours is one row per task there.
    """
    current = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        current = stored(_star(_star(current, True), False), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    own = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(own)
