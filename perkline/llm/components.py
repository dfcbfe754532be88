"""Connected components of a graph given by its edges, without gathering any node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.llm.storage import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b: numbers, not null); the component is its smallest node.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to the
    smallest node around it, then its smaller neighbours are. Each step takes minima, in the map tasks
    first, and joins them back by node: two numbers an edge, and what a node with very many edges
    has too much for one task is split by the adaptive join. The rounds grow with the logarithm of the
    longest chain. Edges from a node to itself and repeated edges are allowed.
    """
    ends = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    now = stored(
        ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges"
    )
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        tied = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        tied = tied.where("u > v").distinct()
        lowest = tied.groupBy("u").agg(F.min("v").alias("low"))
        rest = tied.join(lowest, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = stored(rest.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct(), "edges")
        # The smallest node of every star no longer changes once the edges do not.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
