"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordflow.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them.

    The minimum of a node is a partial aggregation and comes back by a join that can be split, so a
    node with very many links needs no task of its own.
    """
    pairs = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = pairs.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        own = least.select("a", F.col("least").alias("b"))
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, label): label is the smallest node that can be reached.

    Nodes without links do not appear; null ends and links of a node with itself are ignored. Each
    round is written to the shared folder. Links never come to the driver.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    now = staged(
        edges.where(F.col("a") != F.col("b")).select(big.alias("a"), small.alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        mark = Observation("links")
        once = _star(_star(now, True), False).observe(
            mark, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("sum")
        )
        now = staged(once, "links")
        if mark.get == seen:
            break
        seen = mark.get
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
