"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Rows (node, component): the smallest node that each node of an edge can reach.

    Nodes are longs; edges may repeat, run either way or be loops. Hubs are
    aggregated before the shuffle, and their joins are skew joins that AQE
    splits. The steps grow with the logarithm of the longest path; each is
    written to the shared folder. No edges give no rows, a node with only a
    loop is its own component.
    """
    # One scan: an edge list that is costly to compute is computed once.
    given = stash(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null"), "edges")
    nodes = given.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    now, mark = given.where("u <> v"), None
    while True:
        now = stash(_small_star(_large_star(now)), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(tied, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
