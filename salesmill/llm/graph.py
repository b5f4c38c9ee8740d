"""Connected components of a link table, by alternating star contractions over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _towards_minimum(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (u > v) edges.

    large: each node's larger neighbours move to the least of the node and its neighbours; else the node and its smaller
    neighbours do. Minima are combined map-side and joined back, so no neighbourhood is gathered.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "node"))
    joined = both.join(least, both["u"] == least["node"])
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its least node) for every node of the links (u, v), in any order; self-links and nulls are ignored.

    Rounds grow with the logarithm of a component's size; each round's edges are written to the shared folder.
    """
    edges = staged(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    for _ in range(max_rounds):
        edges = staged(_towards_minimum(_towards_minimum(edges, large=True), large=False))
        # Done when every node that is not a root has one edge, and that to a root.
        nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)).distinct())
        busy = nodes.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n")).where("ups > 1 or (ups = 1 and n > 1)")
        if busy.isEmpty():
            break
    else:
        raise RuntimeError(f"components need more than {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
