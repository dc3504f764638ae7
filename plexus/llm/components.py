"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.session import drop_table, materialize, observation


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v): every node points its neighbours (the larger ones,
    or itself and the smaller ones) at the smallest node it sees. The smallest nodes are written,
    so that adaptive execution can split the links of a root that holds a large component."""
    if large:
        near = edges.union(edges.select("v", "u"))
        low = materialize(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "round")
        out = near.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "round")
        out = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct(), low


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node that has an edge.

    ``edges``: two long columns u, v. Large-star and small-star steps alternate until
    nothing changes; each halves the depth of the trees they build, so the rounds
    grow with the logarithm of the longest chain. Each round is written to the shared
    folder, which cuts the lineage; the change test is observed on that write."""
    edges = materialize(edges.toDF("u", "v").where("u <> v").distinct(), "round")
    before = None
    while True:
        obs = observation("links")
        state = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                          F.lit(0).cast("decimal(38,0)")).alias("h"))
        large, low = _star(edges, True)
        large = materialize(large, "round")
        small, least = _star(large, False)
        rounds = (edges, low, large, least)
        edges, now = materialize(small, "round", (obs, *state))
        for table in rounds:  # superseded
            drop_table(table)
        if now == before or not now.get("n"):
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select("v", "v").distinct())
