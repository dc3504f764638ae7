"""Triangle count per user on the simple undirected graph (self-loops removed).

Each undirected edge is oriented from the lower-degree end to the higher-degree
end (ties by id), so a node has at most sqrt(2E) out-neighbours, hubs included. They
are kept as one array a node. Every triangle is found once, at the edge (x, y) between
its first two nodes, as a common out-neighbour z: the edge brings the array of x and meets that
of y, so a row is shuffled an edge and not one a pair of neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.operators.graph import Graph
from plexus.session import checkpoint, drop_table


def simple_undirected(graph: Graph) -> DataFrame:
    p = graph.projection.where(F.col("src") != F.col("dst"))
    return p.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def triangles_per_vertex(graph: Graph) -> DataFrame:
    """(vid, triangles) for every vertex, zeros included."""
    und = checkpoint(simple_undirected(graph))
    deg = checkpoint(und.select(F.explode(F.array("a", "b")).alias("vid"))
                     .groupBy("vid").agg(F.count(F.lit(1)).alias("deg")))
    ranked = (und.join(graph.small(deg.select(F.col("vid").alias("a"), F.col("deg").alias("da"))), "a")
              .join(graph.small(deg.select(F.col("vid").alias("b"), F.col("deg").alias("db"))), "b"))
    a_first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    oriented = ranked.select(F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("x"),
                             F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("y"))
    after = checkpoint(oriented.groupBy("x").agg(F.collect_list("y").alias("ys")))  # at most sqrt(2E) of them
    edges = after.select("x", F.explode("ys").alias("y"), "ys")
    third = edges.join(after.select(F.col("x").alias("y"), F.col("ys").alias("zs")), "y").select(
        "x", "y", F.array_intersect("ys", "zs").alias("z")).where(F.size("z") > 0)
    n = F.size("z").cast("long")
    one = F.transform("z", lambda z: F.struct(z.alias("vid"), F.lit(1).cast("long").alias("n")))
    corners = (third.select(F.explode(F.concat(F.array(F.struct(F.col("x").alias("vid"), n.alias("n")),
                                                       F.struct(F.col("y").alias("vid"), n.alias("n"))), one)).alias("c"))
               .groupBy("c.vid").agg(F.sum("c.n").alias("triangles")))
    out = checkpoint(graph.vertices.select("vid").join(corners, "vid", "left")
                     .select("vid", F.coalesce("triangles", F.lit(0)).cast("long").alias("triangles")))
    for table in (und, deg, after):
        drop_table(table)
    return out


def triangle_count(graph: Graph) -> DataFrame:
    return graph.user_names(triangles_per_vertex(graph)).select("user", "vid", F.col("triangles").alias("triangle_count"))

