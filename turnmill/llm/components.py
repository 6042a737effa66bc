"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.session import save_step


def _minimum(edges: DataFrame) -> DataFrame:
    """Per node u the smallest of its neighbours v and itself; summed before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_minimum(both), "u").filter("v > u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    lower = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = _minimum(lower)
    tied = lower.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v"))).filter("u > v")


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Rows (id, label) for every node of a link but the smallest of its component,
    whose id is the label. Each round is written to the shared folder; the number
    of rounds grows with the logarithm of the longest chain, not with its length.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = save_step(edges.filter("u > v").distinct(), "links")
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
        mark = state
        edges = save_step(_small_star(_large_star(edges).distinct()).distinct(), "links")
