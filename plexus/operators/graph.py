"""Interaction multigraph as DataFrames: vertices, resolved edges, weighted projection.

Vertices get a dense ``vid`` (0..V-1 in user-id order) so every graph loop joins
on longs. The weighted projection ``(src, dst, w)`` collapses parallel edges
(``w`` = their number), which is what all iterative algorithms consume; it is
written once to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import materialize, observation, written_bytes

# A side is broadcast only when its size is known and below this: fixed-width rows by
# their count, tables with names by the bytes of their written files.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32  # a row of up to three numbers
TEXT_GROWTH = 4  # rows in memory next to their Parquet files


def small_rows(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of numbers only while ``rows`` (counted) keep it small."""
    return F.broadcast(df) if rows * ROW_BYTES <= BROADCAST_BYTES else df


def dense_index(df: DataFrame, col: str, out_col: str = "vid") -> DataFrame:
    """Distributed dense rank of the distinct values of ``col`` (0-based, ascending).

    Range-partition + sort inside partitions, then a per-partition offset table
    (one row per partition: a proven size bound, so it is broadcast). No
    single-partition window over the data. The sorted table is written first so
    that the ids are stable if a task is re-run.
    """
    sorted_df = (df.select(col).distinct()
                 .repartitionByRange(col).sortWithinPartitions(col)
                 .select(col, F.spark_partition_id().alias("_pid"),
                         F.monotonically_increasing_id().alias("_mid")))
    sorted_df = materialize(sorted_df, "dense")
    per_part = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (sorted_df.join(F.broadcast(offsets), "_pid")
            .select(col, (F.col("_mid") - F.col("_m0") + F.col("_off")).alias(out_col)))


def vertex_ids(edges: DataFrame) -> DataFrame:
    """Distinct users of both ends (null ends excluded), from one scan."""
    ends = edges.select(F.explode(F.array("user_from", "user_to")).alias("user"))
    return ends.where(F.col("user").isNotNull()).distinct()


def resolve_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Endpoint resolution: two inner equi-joins to the vertices. Rows whose
    endpoint is null or unknown drop out; parallel edges are kept."""
    v_src = vertices.select(F.col("user").alias("user_from"), F.col("vid").alias("src"))
    v_dst = vertices.select(F.col("user").alias("user_to"), F.col("vid").alias("dst"))
    return edges.join(v_src, "user_from").join(v_dst, "user_to")


def weighted_projection(resolved: DataFrame) -> DataFrame:
    """(src, dst, w) with w = number of parallel edges; partial aggregation first."""
    return resolved.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def resolved_pairs(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """The weighted projection of ``resolve_edges`` without its rows: parallel edges are counted by their
    names first, so the two joins see a row a pair."""
    pairs = edges.groupBy("user_from", "user_to").agg(F.count(F.lit(1)).alias("w"))
    return resolve_edges(pairs, vertices).select("src", "dst", "w")


def undirected(projection: DataFrame) -> DataFrame:
    """Symmetric weights: A(u,v) = w(u->v) + w(v->u); a self-loop counts twice in A(u,u),
    so the row sums of A are the total (in + out) degrees."""
    both = (projection.select("src", "dst", "w")
            .union(projection.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
    return both.groupBy("src", "dst").agg(F.sum("w").alias("w"))


@dataclass
class Graph:
    """Materialised graph tables plus the counts that bound what may be broadcast."""
    vertices: DataFrame      # (user, vid)
    projection: DataFrame    # (src, dst, w)
    n_vertices: int
    n_pairs: int
    n_edges: int
    vertex_bytes: int        # of the written vertex table, names included
    resolved: Callable[[], DataFrame]  # writes the edge rows

    @cached_property
    def edges(self) -> DataFrame:
        """Resolved edge rows: user_from, user_to, action, event_time, ..., src, dst. Written when
        first asked for: the searches, rankings and communities need the projection only."""
        return self.resolved()

    def small(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Broadcast a table of numbers (one row a user, or ``rows``) while it is small."""
        return small_rows(df, self.n_vertices if rows is None else rows)

    def user_names(self, df: DataFrame, on: str = "vid", as_col: str = "user") -> DataFrame:
        """Attach user ids to a vid-keyed result."""
        names = self.vertices.select(F.col("vid").alias(on), F.col("user").alias(as_col))
        if self.vertex_bytes * TEXT_GROWTH <= BROADCAST_BYTES:
            names = F.broadcast(names)
        return df.join(names, on)


def build_graph(edges: DataFrame) -> Graph:
    """Gold edges -> vertices (dense ids) and the weighted projection, each written once; the counts are
    observed on the writes. ``edges`` is read twice (for its users, and for its pairs), and a third
    time if its resolved rows are asked for, so pass a written table."""
    v_obs, p_obs = observation("vertices"), observation("pairs")
    rows = F.count(F.lit(1)).alias("n")
    vertices, v = materialize(dense_index(vertex_ids(edges), "user", "vid"), "vertices", observe=(v_obs, rows))
    projection, p = materialize(resolved_pairs(edges, vertices), "projection", observe=(p_obs, rows, F.sum("w").alias("w")))
    vertex_bytes = sum(written_bytes(vertices.sparkSession, f.rsplit("/", 1)[0]) for f in vertices.inputFiles()[:1])
    return Graph(vertices=vertices, projection=projection, n_vertices=int(v["n"]), n_pairs=int(p["n"]),
                 n_edges=int(p["w"] or 0), vertex_bytes=vertex_bytes,
                 resolved=lambda: materialize(resolve_edges(edges, vertices), "edges"))


# ---------------------------------------------------------------- simple statistics

def undirected_pattern(graph: Graph, scores: DataFrame, metric: str = "pagerank",
                       threshold: float = 0.01) -> DataFrame:
    """``(u)-[r]-(u2)`` with ``metric > threshold`` at both ends, matched without
    direction: every edge row comes out once per orientation, a self-loop once.

    Rows: (u, u_<metric>, action, event_time, u2, u2_<metric>). The written edge table
    is read once, each row exploded into its orientations; the vertex-sized score
    table is broadcast only while it is small.
    """
    keep = scores.where(F.col(metric) > threshold).select("vid", metric)
    e = graph.edges.select("user_from", "user_to", "src", "dst", "action", "event_time")
    def side(u: str, a: str, u2: str, b: str):
        return F.struct(F.col(u).alias("u"), F.col(a).alias("a"), F.col(u2).alias("u2"), F.col(b).alias("b"))

    fwd, rev = side("user_from", "src", "user_to", "dst"), side("user_to", "dst", "user_from", "src")
    both = F.when(F.col("src") == F.col("dst"), F.array(fwd)).otherwise(F.array(fwd, rev))
    rows = e.select("action", "event_time", F.explode(both).alias("o")).select("action", "event_time", "o.*")
    at_a = graph.small(keep.select(F.col("vid").alias("a"), F.col(metric).alias(f"u_{metric}")))
    at_b = graph.small(keep.select(F.col("vid").alias("b"), F.col(metric).alias(f"u2_{metric}")))
    return (rows.join(at_a, "a").join(at_b, "b")
            .select("u", f"u_{metric}", "action", "event_time", "u2", f"u2_{metric}"))


def degrees(graph: Graph) -> DataFrame:
    """Out, in and total degree (parallel edges counted) for every user, zeros included."""
    outs = graph.projection.groupBy(F.col("src").alias("vid")).agg(F.sum("w").alias("out_degree"))
    ins = graph.projection.groupBy(F.col("dst").alias("vid")).agg(F.sum("w").alias("in_degree"))
    d = (graph.vertices.join(outs, "vid", "left").join(ins, "vid", "left")
         .select("user", "vid",
                 F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
                 F.coalesce("in_degree", F.lit(0)).alias("in_degree")))
    return d.withColumn("total_degree", F.col("out_degree") + F.col("in_degree"))


def graph_counts(graph: Graph) -> DataFrame:
    """Node and relationship counts of the stored and the projected graph."""
    rel = graph.projection.agg(F.sum("w").alias("total_relationships"),
                               F.count(F.lit(1)).alias("distinct_pairs"))
    return rel.select(F.lit(graph.n_vertices).cast("long").alias("total_nodes"),
                      F.col("total_relationships").cast("long").alias("total_relationships"),
                      F.lit(graph.n_vertices).cast("long").alias("projected_nodes"),
                      F.col("total_relationships").cast("long").alias("projected_relationships"),
                      "distinct_pairs")


def graph_stats(graph: Graph) -> DataFrame:
    """Simple-digraph statistics: nodes, edges (distinct pairs), density m/(n(n-1)),
    mean degree 2m/n."""
    pairs = graph.projection.select("src", "dst")
    n = F.lit(graph.n_vertices).cast("double")
    m = pairs.agg(F.count(F.lit(1)).alias("m"))
    return m.select(
        F.lit(graph.n_vertices).cast("long").alias("nodes"),
        F.col("m").alias("edges"),
        F.when(n > 1, F.col("m") / (n * (n - 1))).otherwise(F.lit(0.0)).alias("density"),
        F.when(n > 0, 2 * F.col("m") / n).otherwise(F.lit(None).cast("double")).alias("mean_degree"),
    )
