"""Community detection on the undirected weighted projection: label propagation,
Louvain, and the modularity of any partition.

Undirected weights: A(u,v) = w(u->v) + w(v->u), a self-loop counts twice in
A(u,u); 2m = sum of A; k(u) = row sum of A (total degree).
Q = sum over communities c of [ in(c) / 2m - (tot(c) / 2m)^2 ].
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.operators.graph import Graph, small_rows, undirected
from plexus.session import checkpoint, drop_table, observation


# ---------------------------------------------------------------- modularity

def modularity_of(sym: DataFrame, labels: DataFrame, node: str = "vid", label: str = "c") -> DataFrame:
    """One-row DataFrame with the modularity of ``labels`` (node -> label) on ``sym``
    (u, v, w symmetric). Two grouped sums and one final aggregate."""
    lab = labels.select(F.col(node).alias("_n"), F.col(label).alias("_c"))
    inner = (sym.join(lab.select(F.col("_n").alias("src"), F.col("_c").alias("cu")), "src")
             .join(lab.select(F.col("_n").alias("dst"), F.col("_c").alias("cv")), "dst"))
    per_c = (inner.groupBy("cu").agg(
        F.sum(F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(F.lit(0))).alias("in_c"),
        F.sum("w").alias("tot_c")))
    # the community totals add up to 2m, so one aggregate gives every term
    q = per_c.agg(F.sum("in_c").cast("double").alias("in_sum"),
                  F.sum(F.col("tot_c").cast("double") * F.col("tot_c")).alias("tot_sq"),
                  F.sum("tot_c").cast("double").alias("two_m"))
    return q.select(
        F.when(F.col("two_m") > 0,
               F.col("in_sum") / F.col("two_m") - F.col("tot_sq") / (F.col("two_m") * F.col("two_m")))
        .otherwise(F.lit(0.0)).alias("modularity"))


def partition_modularity(graph: Graph, communities: DataFrame, user_col: str = "user",
                         community_col: str = "community_louvain") -> DataFrame:
    """Modularity of a given user partition. Users with a negative or null label
    are singletons."""
    lab = communities.select(F.col(user_col).alias("user"), F.col(community_col).alias("c"))
    key = F.when(F.col("c") >= 0, F.concat(F.lit("c"), F.col("c").cast("string"))) \
        .otherwise(F.concat(F.lit("u"), F.col("user")))
    lab = graph.vertices.join(lab, "user", "left").select("vid", key.alias("c"))
    return modularity_of(undirected(graph.projection), lab)


# ---------------------------------------------------------------- label propagation

def _winners(votes: DataFrame, n_labels: int, most: int) -> DataFrame:
    """(vid, new): of the votes (src, label, score) of each node the label with the highest score, ties to the
    smallest. Labels lie below ``n_labels`` and scores up to ``most``; while both fit into one number
    its maximum is a hash aggregate, a maximum of structs sorts the votes."""
    by_node = votes.groupBy(F.col("src").alias("vid"))
    if (most + 1) * n_labels < 1 << 63:
        last = F.lit(n_labels - 1).cast("long")
        best = by_node.agg(F.max(F.col("score") * n_labels + (last - F.col("label"))).alias("b"))
        return best.select("vid", (last - F.pmod("b", F.lit(n_labels).cast("long"))).alias("new"))
    best = by_node.agg(F.max(F.struct("score", (-F.col("label")).alias("neg"))).alias("b"))
    return best.select("vid", (-F.col("b.neg")).alias("new"))


def label_propagation_run(graph: Graph, max_iter: int = 10):
    """Synchronous label propagation: every user starts with its own id and takes
    the label with the largest total edge weight among its neighbours (self-loops
    are not votes; ties -> smallest label); users without neighbours keep theirs.
    Stops when no label changes or after ``max_iter`` rounds."""
    sym = checkpoint(undirected(graph.projection).where(F.col("src") != F.col("dst")))
    labels = checkpoint(graph.vertices.select("vid", F.col("vid").alias("label")))
    ran = 0
    for it in range(1, max_iter + 1):
        votes = (sym.join(small_rows(labels, graph.n_vertices).select(F.col("vid").alias("dst"), "label"), "dst")
                 .groupBy("src", "label").agg(F.sum("w").alias("score")))
        best = _winners(votes, graph.n_vertices, 2 * graph.n_edges)
        nxt = (labels.join(best, "vid", "left")
               .select("vid", F.coalesce("new", "label").alias("label"),
                       (F.col("new").isNotNull() & (F.col("new") != F.col("label"))).alias("changed")))
        obs = observation("lpa")
        nxt = checkpoint(nxt.observe(obs, F.count_if("changed").alias("changed")))
        drop_table(labels)
        labels = nxt.select("vid", "label")
        ran = it
        if int(obs.get["changed"] or 0) == 0:
            break
    drop_table(sym)
    return labels, {"ran_iterations": ran, "max_iterations": max_iter}


def label_propagation(graph: Graph, max_iter: int = 10) -> DataFrame:
    labels, _ = label_propagation_run(graph, max_iter)
    return graph.user_names(labels).select("user", "vid", F.col("label").alias("community_lp"))


# ---------------------------------------------------------------- Louvain

MOST_PARTS = 64


def _proposals(off: DataFrame, comm: DataFrame, n_nodes: int, two_m: float) -> DataFrame:
    """(n, k, c, to, gain, stay): the best community of each node and what the move gains
    over staying (in units of weight; 2 / 2m of it is the change of Q). Ties: smallest label."""
    tot = comm.groupBy("c").agg(F.sum("k").alias("tot"))
    kin = (off.join(small_rows(comm.select(F.col("n").alias("dst"), F.col("c").alias("cv")), n_nodes), "dst")
           .select(F.col("src").alias("n"), "cv", F.col("w").alias("kin")))
    me = comm.select("n", F.col("c").alias("cu"), "k")
    # candidate communities of each node: its neighbours' and its own
    cand = (kin.unionByName(me.select("n", F.col("cu").alias("cv"), F.lit(0).cast("long").alias("kin")))
            .groupBy("n", "cv").agg(F.sum("kin").alias("kin")))
    own = F.when(F.col("cv") == F.col("cu"), F.col("k")).otherwise(F.lit(0))
    cand = (cand.join(small_rows(me, n_nodes), "n")
            .join(small_rows(tot.select(F.col("c").alias("cv"), "tot"), n_nodes), "cv")
            .select("n", "cu", "cv", "k", (F.col("kin") - F.col("k") * (F.col("tot") - own) / F.lit(two_m)).alias("gain")))
    best = (cand.groupBy("n", "cu", "k")
            .agg(F.max(F.struct("gain", (-F.col("cv")).alias("neg"))).alias("b"),
                 F.max(F.when(F.col("cv") == F.col("cu"), F.col("gain"))).alias("stay")))
    return best.select("n", "k", F.col("cu").alias("c"), (-F.col("b.neg")).alias("to"),
                       (F.col("b.gain") - F.col("stay")).alias("gain"), "stay")


def _apart(moves: DataFrame) -> DataFrame:
    """Of all moves (n, k, c, to, gain) those that are best at both their communities: no
    two of them touch the same community, so their gains add up exactly."""
    rank = F.struct("gain", (-F.col("n")).alias("neg"))
    ends = moves.select(F.explode(F.array("c", "to")).alias("at"), rank.alias("r"))
    top = ends.groupBy("at").agg(F.max("r").alias("top"))
    return (moves.withColumn("r", rank)
            .join(top.select(F.col("at").alias("c"), F.col("top").alias("t1")), "c")
            .join(top.select(F.col("at").alias("to"), F.col("top").alias("t2")), "to")
            .where((F.col("r") == F.col("t1")) & (F.col("r") == F.col("t2"))).select("n", F.lit(True).alias("goes")))


def _local_moves(sym: DataFrame, nodes: DataFrame, n_nodes: int, two_m: float, level: int, tol: float):
    """Parallel local moving on one level, until no single move gains more than ``tol`` in
    Q. ``nodes``: (n, k), written. Returns (table with n and c, Q, moved?).

    A round is one job: it applies moves of the last proposals and writes the next ones,
    while it observes what Q the moves led to (the sum of what all nodes lose by
    leaving, up to a constant) and which hash classes still have nodes that would gain
    (at most MOST_PARTS numbers). Only one of ``parts`` classes moves in a round (all at
    once would swap for ever), each in its turn; if the joint effect lowers Q, the
    last proposals are taken up again with twice as many classes. Above
    MOST_PARTS classes only moves that touch no common community are made, whose
    gains add up, so those rounds always rise.
    """
    off = sym.where(F.col("src") != F.col("dst"))
    sums = (sym.agg(F.sum(F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0)).cast("double").alias("loops"))
            .crossJoin(nodes.agg(F.sum(F.col("k").cast("double") * F.col("k")).alias("squares"))).first())  # one row each
    base = float(sums["loops"] or 0) - float(sums["squares"] or 0) / two_m
    gains = (F.col("gain") * (2 / two_m) > tol) & (F.col("to") != F.col("c"))
    hashed = F.xxhash64("n", F.lit(level))

    def propose(comm: DataFrame):
        obs = observation("louvain")
        out = checkpoint(_proposals(off, comm, n_nodes, two_m).observe(
            obs, F.sum("stay").alias("stay"), F.collect_set(F.when(gains, F.pmod(hashed, F.lit(MOST_PARTS)))).alias("classes")))
        got = obs.get
        return out, (float(got["stay"] or 0) + base) / two_m, got["classes"] or []

    moves, q, classes = propose(nodes.select("n", F.col("n").alias("c"), "k"))
    moved, parts, turn = False, 2, 0
    while classes:
        if parts <= MOST_PARTS:
            turn = min({c % parts for c in classes}, key=lambda c: (c - turn) % parts)
            chosen = moves.withColumn("goes", gains & (F.pmod(hashed, F.lit(parts)) == turn))
        else:
            chosen = moves.join(_apart(moves.where(gains)), "n", "left").withColumn("goes", F.coalesce("goes", F.lit(False)))
        nxt, q_new, left = propose(chosen.select(
            "n", F.when(F.col("goes"), F.col("to")).otherwise(F.col("c")).alias("c"), "k"))
        if q_new > q:
            drop_table(moves)
            moves, q, classes, moved = nxt, q_new, left, True
            turn += 1
        else:
            drop_table(nxt)
            if parts > MOST_PARTS:  # what is left is below the precision of Q
                break
            parts *= 2
    return moves, q, moved


def connected_parts(off: DataFrame, comm: DataFrame, n_nodes: int) -> DataFrame:
    """(n, c): each community of ``comm`` cut into its connected parts, named by their smallest
    node, written. A node takes the smallest name among its neighbours of the same
    community and then the name of that name's node, so the rounds grow with the logarithm
    of the longest chain."""
    lab = comm.select("n", "c")
    inner = checkpoint(
        off.join(small_rows(lab.select(F.col("n").alias("src"), F.col("c").alias("cs")), n_nodes), "src")
        .join(small_rows(lab.select(F.col("n").alias("dst"), F.col("c").alias("cd")), n_nodes), "dst")
        .where("cs = cd").select("src", "dst"))
    parts = checkpoint(lab.select("n", F.col("n").alias("p")))
    while True:
        names = small_rows(parts, n_nodes)
        near = (inner.join(names.select(F.col("n").alias("dst"), "p"), "dst")
                .groupBy(F.col("src").alias("n")).agg(F.min("p").alias("near")))
        low = parts.join(near, "n", "left").select("n", "p", F.least("p", "near").alias("low"))
        there = names.select(F.col("n").alias("low"), F.col("p").alias("further"))
        obs = observation("parts")
        nxt = checkpoint(low.join(there, "low").select("n", F.least("low", "further").alias("q"), "p").observe(
            obs, F.count_if(F.col("q") != F.col("p")).alias("changed")))
        changed = int(obs.get["changed"] or 0)
        drop_table(parts)
        parts = nxt.select("n", F.col("q").alias("p"))
        if not changed:
            break
    drop_table(inner)
    return parts.select("n", F.col("p").alias("c"))


def louvain_run(graph: Graph, max_levels: int | None = None, tol: float = 1e-7):
    """Multi-level Louvain. Returns (labels (vid, community), summary).

    Level loop: local moves, then each community is cut into its connected parts (a node
    that left may have held two parts together; apart they have a higher Q), then contraction of
    each part into one node (internal weight becomes a self-loop), until a level moves
    nothing. So every community is connected. Labels are the
    smallest member vid of each final community. Every table is checkpointed;
    nothing is collected. ``max_levels`` stops earlier on request, which the summary
    says in ``converged``.
    """
    sym = checkpoint(undirected(graph.projection))
    two_m = float(sym.agg(F.sum("w")).first()[0] or 0.0)
    member = graph.vertices.select("vid", F.col("vid").alias("n"))
    n_nodes = graph.n_vertices
    levels_q = []
    if two_m == 0:
        labels = graph.vertices.select("vid", F.col("vid").alias("community"))
        return labels, {"community_count": n_nodes, "modularity": 0.0, "ran_levels": 0, "modularities": [], "converged": True}
    converged = False
    for level in itertools.count():
        if max_levels is not None and level >= max_levels:
            break
        nodes = checkpoint(sym.groupBy(F.col("src").alias("n")).agg(F.sum("w").alias("k")))
        comm, q, moved = _local_moves(sym, nodes, n_nodes, two_m, level, tol)
        if not moved:
            converged = True
            if not levels_q:
                levels_q.append(q)
            break
        off = sym.where(F.col("src") != F.col("dst"))
        cmap = connected_parts(off, comm, n_nodes)
        if cmap.select("c").distinct().count() != comm.select("c").distinct().count():
            q = float(modularity_of(sym, cmap, node="n").first()["modularity"])
        levels_q.append(q)
        old_member, old_sym = member, sym
        member = checkpoint(member.join(small_rows(cmap, n_nodes), "n").select("vid", F.col("c").alias("n")))
        sym = checkpoint(
            sym.join(small_rows(cmap.select(F.col("n").alias("src"), F.col("c").alias("cs")), n_nodes), "src")
            .join(small_rows(cmap.select(F.col("n").alias("dst"), F.col("c").alias("cd")), n_nodes), "dst")
            .groupBy(F.col("cs").alias("src"), F.col("cd").alias("dst")).agg(F.sum("w").alias("w")))
        n_nodes = cmap.select("c").distinct().count()
        for done in (comm, cmap, old_member, old_sym, nodes):
            drop_table(done)
    labels = member.groupBy("n").agg(F.min("vid").alias("community"))
    labels = checkpoint(member.join(labels, "n").select("vid", "community"))
    n_comm = labels.select("community").distinct().count()
    return labels, {"community_count": n_comm, "modularity": levels_q[-1] if levels_q else 0.0,
                    "ran_levels": len(levels_q), "modularities": levels_q, "converged": converged}


def louvain(graph: Graph, **kw) -> DataFrame:
    labels, _ = louvain_run(graph, **kw)
    return graph.user_names(labels).select("user", "vid", F.col("community").alias("community_louvain"))
