"""User metrics table and the influencer / community queries built on it.

Every query takes *any* metrics table ``(user, pagerank, betweenness,
community_louvain)``: the real one from the graph algorithms, or the exact
``metrics_fixed`` view used for SQL checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.ranking import average_rank_desc, top_k_per_group
from plexus.operators.graph import Graph, degrees

ROUND = 6


def metrics_fixed(graph: Graph) -> DataFrame:
    """Deterministic stand-in metrics derived from the graph alone:
    pagerank = out-degree / all interactions, betweenness = in-degree,
    community = (numeric part of the user id) % 7 - 1 (so -1 = unassigned occurs)."""
    num = F.regexp_extract(F.col("user"), r"(\d+)$", 1).try_cast("long")
    return (degrees(graph)
            .select("user",
                    (F.col("out_degree") / F.lit(float(graph.n_edges))).alias("pagerank"),
                    F.col("in_degree").cast("double").alias("betweenness"),
                    (num % 7 - 1).alias("community_louvain")))


def user_metrics(graph: Graph, pagerank: DataFrame | None = None, betweenness: DataFrame | None = None,
                 communities: DataFrame | None = None) -> DataFrame:
    """Write-back of each metric onto every user (left joins on the user id).
    Metrics not computed stay null; ``export_metrics`` applies the defaults."""
    out = graph.vertices.select("user", "vid")
    for df, col, typ in ((pagerank, "pagerank", "double"), (betweenness, "betweenness", "double"),
                         (communities, "community_louvain", "long")):
        if df is None:
            out = out.withColumn(col, F.lit(None).cast(typ))
        else:
            out = out.join(df.select("vid", col), "vid", "left")
    return out.drop("vid")


def _present(name: str) -> Column:
    """The column with NaN read as missing, as a pandas ``fillna`` would."""
    c = F.col(name)
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(None)).otherwise(c)


def present(metrics: DataFrame) -> DataFrame:
    """The metrics with NaN read as null; every ranking and statistic starts here."""
    names = [c for c in ("pagerank", "betweenness", "community_louvain") if c in metrics.columns]
    return metrics.withColumns({c: _present(c) for c in names})


def export_metrics(metrics: DataFrame) -> DataFrame:
    """Coalesced metrics (0, 0, -1), ordered by the *raw* pagerank, nulls first
    (NaN counts as missing)."""
    m = present(metrics)
    return m.select(
        "user", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
        F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"),
        F.coalesce("community_louvain", F.lit(-1)).cast("long").alias("community_louvain"),
        F.col("pagerank").alias("_raw"),
    ).orderBy(F.col("_raw").desc_nulls_first(), "user").drop("_raw")


def top_by(metrics: DataFrame, metric: str = "pagerank", n: int = 10, cols: list[str] | None = None) -> DataFrame:
    """Top ``n`` users by ``metric`` (ties by user id, missing last), values rounded for display."""
    cols = cols or [metric]
    return (present(metrics).orderBy(F.col(metric).desc_nulls_last(), "user").limit(n)
            .select("user", *[F.round(c, ROUND).alias(c) for c in cols]))


def influence_score(metrics: DataFrame, n: int = 20) -> DataFrame:
    """pagerank + betweenness / 1000 over users having both, top ``n``."""
    keep = [c for c in ("community_louvain",) if c in metrics.columns]
    scored = (present(metrics).where(F.col("pagerank").isNotNull() & F.col("betweenness").isNotNull())
              .withColumn("influence_score", F.col("pagerank") + F.col("betweenness") / 1000))
    return (scored.orderBy(F.desc("influence_score"), "user").limit(n)
            .select("user", F.round("pagerank", ROUND).alias("pagerank"),
                    F.round("betweenness", ROUND).alias("betweenness"), *keep,
                    F.round("influence_score", ROUND).alias("influence_score")))


def user_rank(metrics: DataFrame, metric: str = "pagerank") -> DataFrame:
    """Every user's rank by ``metric`` (descending, average rank on ties, truncated;
    NaN is missing and ranks last with the nulls)."""
    return (average_rank_desc(present(metrics).select("user", metric), metric)
            .select("user", F.round(metric, ROUND).alias(metric), "rank"))


def user_profile(metrics: DataFrame, user: str, metric: str = "pagerank") -> DataFrame:
    """One user's metrics and the rank that ``user_rank`` gives them."""
    cols = [c for c in ("pagerank", "betweenness", "community_louvain") if c in metrics.columns]
    m = present(metrics)
    own = m.where(F.col("user") == user)
    # one row (the user) beside every row: a count of the users above and of the ties, no sort
    beside = m.select(F.col(metric).alias("_v")).crossJoin(F.broadcast(own.select(F.col(metric).alias("_own"))))
    missing = F.col("_own").isNull()
    above = F.when(missing, F.col("_v").isNotNull()).otherwise(F.coalesce(F.col("_v") > F.col("_own"), F.lit(False)))
    counts = beside.agg(F.count_if(above).alias("_above"), F.count_if(F.col("_v").eqNullSafe(F.col("_own"))).alias("_ties"))
    rank = F.floor(F.col("_above") + (F.col("_ties") + 1) / 2.0).cast("long")
    return own.crossJoin(F.broadcast(counts)).select(
        "user", *[F.round(c, ROUND).alias(c) if c != "community_louvain" else F.col(c) for c in cols], rank.alias("rank"))


def metric_stats(metrics: DataFrame, names: tuple[str, ...] = ("pagerank", "betweenness")) -> DataFrame:
    """min, max, mean and sample standard deviation per metric (one scan, then unpivot)."""
    aggs = []
    for m in names:
        aggs += [F.min(m).alias(f"{m}__min"), F.max(m).alias(f"{m}__max"),
                 F.avg(m).alias(f"{m}__avg"), F.stddev_samp(m).alias(f"{m}__std")]
    one = present(metrics).agg(*aggs)
    rows = [F.struct(F.lit(m).alias("metric"),
                     *[F.round(F.col(f"{m}__{s}"), ROUND).alias(s) for s in ("min", "max", "avg", "std")])
            for m in names]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_n_stats(metrics: DataFrame, metric: str = "pagerank", n: int = 20) -> DataFrame:
    """Over the top ``n`` by ``metric``: the top user, mean and sample std."""
    top = present(metrics).orderBy(F.col(metric).desc_nulls_last(), "user").limit(n)
    return top.agg(F.min_by("user", F.struct(F.col(metric).isNull(), -F.col(metric), F.col("user"))).alias("top_user"),
                   F.round(F.avg(metric), ROUND).alias("mean"),
                   F.round(F.stddev_samp(metric), ROUND).alias("std"),
                   F.count(F.lit(1)).alias("n"))


def metric_coverage(metrics: DataFrame) -> DataFrame:
    return present(metrics).agg(F.count("pagerank").alias("users_with_pagerank"),
                       F.count("betweenness").alias("users_with_betweenness"),
                       F.count("community_louvain").alias("users_with_community"))


def users_missing_metrics(metrics: DataFrame) -> DataFrame:
    return (present(metrics).where(F.col("pagerank").isNull() | F.col("betweenness").isNull())
            .select("user", "pagerank", "betweenness"))


def metric_correlation(metrics: DataFrame) -> DataFrame:
    """Pearson coefficient of pagerank and betweenness over every user."""
    return present(metrics).agg(F.count(F.lit(1)).alias("n"),
                       F.round(F.corr("pagerank", "betweenness"), ROUND).alias("pearson"))


def metric_pairs(metrics: DataFrame) -> DataFrame:
    """The points behind the coefficient: every user with both metrics."""
    return (present(metrics).where(F.col("pagerank").isNotNull() & F.col("betweenness").isNotNull())
            .select("user", F.round("pagerank", ROUND).alias("pagerank"), F.round("betweenness", ROUND).alias("betweenness")))


# ---------------------------------------------------------------- communities

def valid_communities(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("community_louvain") >= 0)


def community_stats(metrics: DataFrame) -> DataFrame:
    """Size, mean and total pagerank, mean betweenness per community (>= 0), largest first."""
    return (valid_communities(metrics).groupBy(F.col("community_louvain").alias("community"))
            .agg(F.count("user").alias("size"),
                 F.round(F.avg("pagerank"), ROUND).alias("avg_pagerank"),
                 F.round(F.sum("pagerank"), ROUND).alias("sum_pagerank"),
                 F.round(F.avg("betweenness"), ROUND).alias("avg_betweenness"))
            .orderBy(F.desc("size"), "community"))


def community_summary(metrics: DataFrame) -> DataFrame:
    """Number of communities and their largest / smallest / mean size (0 when none)."""
    sizes = valid_communities(metrics).groupBy("community_louvain").agg(F.count("user").alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("n_communities"),
                     F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
                     F.coalesce(F.min("size"), F.lit(0)).alias("smallest"),
                     F.coalesce(F.round(F.avg("size"), ROUND), F.lit(0.0)).alias("mean_size"))


def community_top(metrics: DataFrame, n: int = 15) -> DataFrame:
    return community_stats(metrics).orderBy(F.desc("size"), "community").limit(n)


def community_top_members(metrics: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` users by pagerank of every community, computed for all at once."""
    ranked = top_k_per_group(valid_communities(metrics).select("user", "pagerank", "community_louvain"),
                             "community_louvain", [F.desc("pagerank"), F.asc("user")], k)
    return ranked.select(F.col("community_louvain").alias("community"), "rank", "user",
                         F.round("pagerank", ROUND).alias("pagerank"))


def community_members(metrics: DataFrame, community: int) -> DataFrame:
    return (metrics.where(F.col("community_louvain") == community)
            .select("user", F.round("pagerank", ROUND).alias("pagerank"),
                    F.round("betweenness", ROUND).alias("betweenness"))
            .orderBy(F.desc("pagerank"), "user"))


# ---------------------------------------------------------------- graph exports

def node_export(metrics: DataFrame) -> DataFrame:
    """Nodes for drawing: pagerank (0 default), community (-1 default), size, colour."""
    pr = F.coalesce("pagerank", F.lit(0.0))
    comm = F.coalesce("community_louvain", F.lit(-1)).cast("long")
    return present(metrics).select(F.col("user").alias("id"), F.round(pr, ROUND).alias("pagerank"),
                          comm.alias("community"), F.round(pr * 1000 + 10, ROUND).alias("size"),
                          comm.alias("color"))


def edge_export(edges: DataFrame, n: int | None = None, with_time: bool = True) -> DataFrame:
    """source, target, action (, timestamp) of every edge in a total order; the first
    ``n`` of them on request (for a drawing)."""
    cols = [F.col("user_from").alias("source"), F.col("user_to").alias("target"), "action"]
    if with_time:
        cols.append(F.col("event_time").alias("timestamp"))
    out = edges.select(*cols)
    order = ["source", "target"] + (["timestamp"] if with_time else []) + ["action"]
    out = out.orderBy(*order)
    return out if n is None else out.limit(n)


def one_hop(edges: DataFrame, metrics: DataFrame, with_community: bool = False, n: int | None = None) -> DataFrame:
    """``(u)-[r]->(u2)`` with the properties of both ends, every match (the first ``n``
    in a total order on request); ``with_community`` keeps pairs that both have one."""
    m = present(metrics)
    if with_community:
        m = valid_communities(m)

    def side(name: str) -> DataFrame:
        return m.select(F.col("user").alias(name), F.round("pagerank", ROUND).alias(f"{name}_pagerank"),
                        F.round("betweenness", ROUND).alias(f"{name}_betweenness"),
                        F.col("community_louvain").alias(f"{name}_community"))

    out = (edges.select(F.col("user_from").alias("u"), "action", "event_time", F.col("user_to").alias("u2"))
           .join(side("u"), "u").join(side("u2"), "u2"))
    out = out.select("u", "u_pagerank", "u_betweenness", "u_community", "action", "event_time",
                     "u2", "u2_pagerank", "u2_betweenness", "u2_community")
    return out if n is None else out.orderBy("u", "u2", "event_time", "action").limit(n)
