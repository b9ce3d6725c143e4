"""Connected components of links that stay distributed: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the smallest neighbour (or the node itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u")
    rest = tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected links (u, v) of longs; the root is the component's smallest node.

    Each round is written to the shared folder and read again, so neither lineage nor driver memory grows; the rounds
    are about the logarithm of the longest path. Loops and repeated links do no harm; no links give no rows.
    """
    edges = staged(edges.select("u", "v").filter("u <> v").distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
        edges = staged(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"links still change after {most_rounds} rounds")
