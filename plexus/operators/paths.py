"""Breadth-first search family: betweenness, closeness, shortest path, ego network.

All searches are level-synchronous and multi-source: a row per node and source, or
per node and group of sources or targets, that has been reached. A level is one join of the newest rows to the
adjacency and one grouped sum that folds the messages into the state. Each level
is written to the shared folder, so no plan grows with the depth of the search
and an executor loss replays at most one level; superseded tables are deleted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.operators.graph import Graph, dense_index, undirected
from plexus.session import at_once, checkpoint, drop_table, observation, ship

# All-pairs searches hold at most about this many (source, node) rows at a time.
STATE_ROWS = 50_000_000


def adjacency(graph: Graph, direction: str = "out") -> DataFrame:
    """(src, dst, w) along the chosen direction: out, in or both (undirected)."""
    p = graph.projection.select("src", "dst", "w")
    if direction == "out":
        return p
    if direction == "in":
        return p.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    if direction == "both":
        return undirected(p)
    raise ValueError(f"direction must be out, in or both, not {direction!r}")


def _batches(n_vertices: int, per_batch: int):
    """Contiguous ranges of ids that cover all vertices. Nothing is sampled."""
    for first in range(0, max(n_vertices, 1), per_batch):
        yield first, first + per_batch - 1


def _added(total: DataFrame | None, part: DataFrame, key: str, *sums: str) -> DataFrame:
    """The running sums with one batch's added, written; so a plan is as wide after the
    last of any number of batches as after the second."""
    if total is None:
        return part
    out = checkpoint(total.unionByName(part).groupBy(key).agg(*[F.sum(c).alias(c) for c in sums]))
    drop_table(total)
    drop_table(part)
    return out


LANES = 64  # sources of one row
PAIRS = 100_000_000  # (source, node) pairs that a batch of sources can reach at most
EDGES = 256  # of one row of the adjacency lists
MESSAGES = 1 << 14  # multiplied at a time
HELD = 1 << 15  # sums that a task keeps back, of LANES numbers each

ROW = "g long, v long, x binary"
FOLDED = ROW + ", y binary, n long"
JUDGED = ROW + ", b double"


def _lists(adj: DataFrame) -> DataFrame:
    """(v, to, w): the edges of each node in rows of about EDGES, so no hub is one row."""
    rows = adj.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / EDGES).alias("parts"))
    each = adj.join(rows, "src").groupBy(F.col("src").alias("v"), F.pmod(F.xxhash64("dst"), F.col("parts")).alias("part"))
    return each.agg(F.collect_list(F.struct("dst", "w")).alias("e")).select(
        "v", F.col("e.dst").alias("to"), F.col("e.w").cast("array<double>").alias("w"))


def _matrix(column: pa.Array, kind, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a binary column have a value, and these as rows of ``width`` numbers."""
    has = column.is_valid().to_numpy(zero_copy_only=False)
    values = b"".join(column.drop_null().to_pylist())
    return has, np.frombuffer(values, kind).reshape(-1, width)


def _binary(rows: np.ndarray, has: np.ndarray) -> pa.Array:
    """A binary column with the bytes of each of ``rows``, null where not ``has``."""
    size = rows.itemsize * rows.shape[1]
    at = np.concatenate([[0], np.cumsum(np.where(has, size, 0))]).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(rows[has]))
    mask = pa.py_buffer(np.packbits(has, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), len(rows), [mask, pa.py_buffer(at), data])


def _runs(g: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Where each (g, v) of sorted rows begins."""
    return np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (v[1:] != v[:-1])]))


def _summed(sums: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    g, v, x = (np.concatenate(c) for c in zip(*sums, strict=True))
    order = np.lexsort((v, g))
    g, v = g[order], v[order]
    first = _runs(g, v)
    return g[first], v[first], np.add.reduceat(x[order], first, axis=0)


def _spread(batches):
    """(g, v, x): rows (g, x) times the weights of their edges, summed at the edges' ends as far as
    the task's memory allows; the rest is summed after the shuffle."""
    def rows(g, v, x):
        return pa.RecordBatch.from_pydict({"g": g, "v": v, "x": _binary(x, np.ones(len(g), bool))})

    held: list[tuple] = []
    for b in batches:
        if not b.num_rows:
            continue
        g, (_, x) = b["g"].to_numpy(), _matrix(b["x"], np.float64, LANES)
        to, w = b["to"].flatten().to_numpy(), b["w"].flatten().to_numpy()
        row = np.repeat(np.arange(len(g)), b["to"].value_lengths().to_numpy())
        order = np.lexsort((to, g[row]))
        for k in range(0, len(order), MESSAGES):
            some = order[k:k + MESSAGES]
            at, v = row[some], to[some]
            first = _runs(g[at], v)
            held.append((g[at][first], v[first], np.add.reduceat(x[at] * w[some, None], first, axis=0)))
            if sum(len(h[0]) for h in held) > HELD:
                held = [_summed(held)]
                if len(held[0][0]) > HELD // 2:
                    yield rows(*held.pop())
    if held:
        yield rows(*_summed(held))


def _fold(finish, width: int):
    """A function over rows (g, v, x, y), sorted, that hands (g, v, the sum of the x, the one y as ``width``
    bytes) of every (g, v) to ``finish``."""
    def run(batches):
        last = None  # of the rows before, its (g, v) may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            g, v = batch["g"].to_numpy(), batch["v"].to_numpy()
            first = _runs(g, v)
            at = np.zeros(len(g), np.int64)
            at[first] = 1
            at = np.cumsum(at) - 1
            x, y = np.zeros((len(first), LANES)), np.zeros((len(first), width), np.uint8)
            has, values = _matrix(batch["x"], np.float64, LANES)
            if len(values):
                begin = np.flatnonzero(np.diff(at[has], prepend=-1))
                x[at[has][begin]] = np.add.reduceat(values, begin, axis=0)
            has, values = _matrix(batch["y"], np.uint8, width)
            y[at[has]] = values
            g, v = g[first], v[first]
            if last is not None:
                if (g[0], v[0]) == (last[0][0], last[1][0]):
                    x[0] += last[2][0]
                    y[0] |= last[3][0]
                else:
                    yield finish(*last)
            last = g[-1:], v[-1:], x[-1:].copy(), y[-1:].copy()
            if len(g) > 1:
                yield finish(g[:-1], v[:-1], x[:-1], y[:-1])
        if last is not None:
            yield finish(*last)
    return run


def _reached(g, v, x, y) -> pa.RecordBatch:
    """Forward: y has a bit for each source that has reached the node; x keeps the new ones' counts."""
    new = (x != 0) & (np.unpackbits(y, axis=1, bitorder="little") == 0)
    n = new.sum(axis=1)
    return pa.RecordBatch.from_pydict({
        "g": g, "v": v, "x": _binary(np.where(new, x, 0.0), n > 0),
        "y": _binary(y | np.packbits(new, axis=1, bitorder="little"), np.ones(len(g), bool)), "n": n})


def _depended(g, v, x, y) -> pa.RecordBatch:
    """Backward: y has sigma of the level's nodes, x the sum of (1 + delta) / sigma over the edges out of
    them; leaves that quotient for the level above and the sum of delta."""
    here = y.any(axis=1)
    sigma = np.ascontiguousarray(y[here]).view(np.float64)
    delta = sigma * x[here]
    quotient = np.divide(1.0 + delta, sigma, out=np.zeros_like(sigma), where=sigma != 0)
    return pa.RecordBatch.from_pydict({"g": g[here], "v": v[here], "x": _binary(quotient, np.ones(len(sigma), bool)),
                                       "b": delta.sum(axis=1)})


def _seeds(sources: DataFrame) -> DataFrame:
    """The sources (s, i) as the first level: lane i of group i / LANES. The lane's place in x and
    in the bits of y is written in hexadecimal digits."""
    lane, bit = F.col("i") % LANES, F.col("i") % 8

    def bytes_around(before, mid, after):
        zero = F.lit("00")
        return F.unhex(F.concat(F.repeat(zero, before.cast("int")), mid, F.repeat(zero, after.cast("int"))))

    one = F.lit(np.float64(1).tobytes().hex())
    byte = F.element_at(F.array(*[F.lit(f"{1 << k:02x}") for k in range(8)]), (bit + 1).cast("int"))
    at = F.floor(lane / 8)
    return sources.select(F.floor(F.col("i") / LANES).alias("g"), F.col("s").alias("v"),
                          bytes_around(lane * 8, one, (LANES - 1 - lane) * 8).alias("x"),
                          bytes_around(at, byte, LANES // 8 - 1 - at).alias("y"), F.lit(1).cast("long").alias("n"))


def _step(front: DataFrame | None, lists: DataFrame | None, old: DataFrame, finish, width: int, schema: str) -> DataFrame:
    """One level: the messages of ``front`` (g, v, x), if any, along ``lists`` meet ``old`` (g, v, y)."""
    none = F.lit(None).cast("binary")
    rows = old.select("g", "v", none.alias("x"), "y")
    if front is not None:
        sent = front.join(lists, "v").select("g", "x", "to", "w").mapInArrow(_spread, ROW)
        rows = rows.unionByName(sent.select("g", "v", "x", none.alias("y")))
    # rows of one group stay together, in stretches of 65,536 nodes
    rows = rows.repartition("g", F.shiftright("v", 16)).sortWithinPartitions("g", "v")
    return rows.mapInArrow(_fold(finish, width), schema)


def _levels(lists: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Multi-source BFS: a written table a level with x, the number of shortest paths from the group's
    sources to the nodes first reached there. Parallel edges multiply (by ``w``)."""
    levels = [_seeds(sources)]
    while True:
        obs = observation("bfs")
        front = levels[-1].where("n > 0").select("g", "v", "x")
        nxt = checkpoint(_step(front, lists, levels[-1], _reached, LANES // 8, FOLDED).observe(obs, F.sum("n").alias("n")))
        if not int(obs.get["n"] or 0):
            drop_table(nxt)
            return levels
        levels.append(nxt)


def _dependencies(graph: Graph, adj: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(v, b): what the sources of one batch add to each node's betweenness, written. Goes
    from the last level up, against the edges out of the nodes of each level; drops the levels."""
    done: list[DataFrame] = []
    for level in levels[:0:-1]:
        sigma = level.where("n > 0").select("g", "v", F.col("x").alias("y"))
        below = back = None
        if done:
            below = done[-1].select("g", "v", "x")
            turned = adj.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
            heads = graph.small(sigma.select(F.col("v").alias("dst")).distinct())
            back = graph.small(_lists(turned.join(heads, "dst", "left_semi")), 2 * graph.n_pairs)
        done.append(checkpoint(_step(below, back, sigma, _depended, LANES * 8, JUDGED)))
        drop_table(level)
    if not done:
        out = checkpoint(levels[0].select("v", F.lit(0.0).alias("b")).limit(0))
    else:
        rows = done[0].select("v", "b")
        for level in done[1:]:
            rows = rows.unionByName(level.select("v", "b"))
        out = checkpoint(rows.groupBy("v").agg(F.sum("b").alias("b")))
    for table in done:
        drop_table(table)
    return out


def _sources(graph: Graph, adj: DataFrame) -> tuple[DataFrame, int]:
    """(s, i), written, and a bound of i: the nodes with out-edges (others reach nothing) and their
    numbers in the groups. Their own ids are near enough together if most nodes are among them."""
    obs = observation("sources")
    own = checkpoint(adj.select(F.col("src").alias("s")).distinct().select("s", F.col("s").alias("i")).observe(
        obs, F.count(F.lit(1)).alias("n")))
    n = int(obs.get["n"] or 0)
    if 2 * n > graph.n_vertices:
        return own, graph.n_vertices
    out = checkpoint(dense_index(own, "s", "i"))
    drop_table(own)
    return out, n


def betweenness_run(graph: Graph, sources_per_batch: int | None = None, direction: str = "out"):
    """Brandes betweenness, directed, unnormalised, endpoints excluded, parallel
    edges counted in the path counts. Exact: every source is processed. A row has LANES
    sources of one node as an array, so an edge is followed once for all of them. The sources go
    in batches by what they can reach at most, the nodes with edges into them; a batch leaves one
    sum per node, which is added to a running total. Returns (DataFrame(vid, betweenness), summary)."""
    ship(graph.vertices.sparkSession)
    adj = adjacency(graph, direction)

    lists, (sources, n_sources), ends = at_once(
        graph.vertices.sparkSession, lambda: checkpoint(_lists(adj)), lambda: _sources(graph, adj),
        lambda: adj.select("dst").distinct().count())
    per_batch = sources_per_batch or max(LANES, PAIRS // (ends + 1) // LANES * LANES)
    total, max_depth = None, 0
    for first, last in _batches(n_sources, per_batch):
        levels = _levels(graph.small(lists, 2 * graph.n_pairs), sources.where(F.col("i").between(first, last)))
        max_depth = max(max_depth, len(levels) - 1)
        total = _added(total, _dependencies(graph, adj, levels), "v", "b")
    out = checkpoint(graph.vertices.select("vid").join(graph.small(total.withColumnRenamed("v", "vid")), "vid", "left")
                     .select("vid", F.coalesce("b", F.lit(0.0)).alias("betweenness")))
    for table in (total, sources, lists):
        drop_table(table)
    return out, {"node_properties_written": graph.n_vertices, "max_depth": max_depth}


def betweenness(graph: Graph, **kw) -> DataFrame:
    scores, _ = betweenness_run(graph, **kw)
    return graph.user_names(scores).select("user", "vid", "betweenness")


WORD = 64  # targets of one row


def _distances(adj: DataFrame, targets: DataFrame) -> DataFrame:
    """(vid, reached, farness): how many of ``targets`` each node reaches along ``adj`` and the sum of
    the distances, written. A row (word, v) has a bit for each of the WORD targets of
    a word: ``seen`` those that v reaches, ``new`` those it reaches in as many steps as
    there were levels. A node gets the new bits of the nodes that its edges lead to."""
    own = F.expr(f"shiftleft(1L, cast(vid % {WORD} as int))")
    zero = F.lit(0).cast("long")
    state = checkpoint(targets.select((F.col("vid") / WORD).cast("long").alias("word"), F.col("vid").alias("v"),
                                      own.alias("seen"), own.alias("new"), zero.alias("reached"), zero.alias("farness")))
    depth = 0
    while True:
        depth += 1
        front = state.where("new <> 0").select("word", F.col("v").alias("dst"), "new")
        msgs = adj.join(front, "dst").select("word", F.col("src").alias("v"), zero.alias("seen"), F.col("new").alias("msg"),
                                             zero.alias("reached"), zero.alias("farness"))
        folded = (state.withColumn("msg", zero).drop("new").unionByName(msgs).groupBy("word", "v")
                  .agg(F.bit_or("seen").alias("seen"), F.bit_or("msg").alias("msg"),
                       F.max("reached").alias("reached"), F.max("farness").alias("farness")))
        new = F.col("msg").bitwiseAND(F.bitwise_not("seen"))
        nxt = folded.select("word", "v", F.col("seen").bitwiseOR(F.col("msg")).alias("seen"), new.alias("new"),
                            (F.col("reached") + F.bit_count(new)).alias("reached"),
                            (F.col("farness") + depth * F.bit_count(new)).alias("farness"))
        obs = observation("levels")
        old, state = state, checkpoint(nxt.observe(obs, F.count_if(F.col("new") != 0).alias("n")))
        drop_table(old)
        if not int(obs.get["n"] or 0):
            break
    out = checkpoint(state.groupBy(F.col("v").alias("vid")).agg(F.sum("reached").alias("reached"), F.sum("farness").alias("farness")))
    drop_table(state)
    return out


def closeness(graph: Graph, direction: str = "out", sources_per_batch: int | None = None) -> DataFrame:
    """reached / sum of distances over the users reachable along ``direction``; 0 when none.

    Searched from the far ends, WORD of them in the bits of one number, so the state is
    a row a node and word and not one a pair; every user is a far end of one batch."""
    adj = adjacency(graph, direction).select("src", "dst").where("src <> dst")
    per_batch = sources_per_batch or WORD * max(1, STATE_ROWS // max(graph.n_vertices, 1))
    total = None
    for first, last in _batches(graph.n_vertices, per_batch):
        part = _distances(adj, graph.vertices.where(F.col("vid").between(first, last)).select("vid"))
        total = _added(total, part, "vid", "reached", "farness")
    score = F.when(F.col("farness") > 0, F.col("reached") / F.col("farness")).otherwise(F.lit(0.0))
    out = checkpoint(graph.vertices.select("vid").join(graph.small(total), "vid", "left")
                     .select("vid", score.alias("closeness")))
    drop_table(total)
    return graph.user_names(out).select("user", "vid", "closeness")


def simple_neighbours(graph: Graph) -> DataFrame:
    """Undirected simple adjacency (src, dst): parallel edges and orientation collapsed."""
    p = graph.projection
    return p.select("src", "dst").union(p.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def _level(nb: DataFrame, reached: DataFrame, depth: int) -> tuple[DataFrame, int]:
    """``reached`` (vid, d) with the nodes at ``depth`` + 1, written, and their number."""
    front = reached.where(F.col("d") == depth).select(F.col("vid").alias("src"))
    msgs = front.join(nb, "src").select(F.col("dst").alias("vid"), F.lit(depth + 1).alias("d"))
    obs = observation("level")
    out = checkpoint(reached.unionByName(msgs).groupBy("vid").agg(F.min("d").alias("d")).observe(
        obs, F.count_if(F.col("d") == depth + 1).alias("n")))
    n = int(obs.get["n"] or 0)
    drop_table(reached)
    return out, n


def shortest_path(graph: Graph, source: str, target: str) -> DataFrame:
    """One shortest undirected path (the lexicographically smallest on ties) as an
    array of user ids; no row when unreachable.

    The search goes from both ends, a level of the end with the smaller front at a
    time, and keeps a distance a node. Where the fronts meet, all nodes on shortest
    paths are found level by level towards the ends; the path takes the smallest of
    them that is next to its last (ids are in user order)."""
    spark = graph.vertices.sparkSession
    ends = graph.vertices.where(F.col("user").isin(source, target)).select("user", "vid").collect()  # two rows
    ids = {r["user"]: r["vid"] for r in ends}
    schema = "source string, target string, length int, path array<string>"
    if source not in ids or target not in ids:
        return spark.createDataFrame([], schema)
    a, b = ids[source], ids[target]
    if a == b:
        return spark.createDataFrame([(source, target, 0, [source])], schema)
    nb = checkpoint(simple_neighbours(graph))
    sides = [checkpoint(graph.vertices.where(F.col("vid") == v).select("vid", F.lit(0).alias("d"))) for v in (a, b)]
    depth, front = [0, 0], [1, 1]
    found: DataFrame | None = None
    while found is None and all(front):
        k = 0 if front[0] <= front[1] else 1
        sides[k], front[k] = _level(nb, sides[k], depth[k])
        depth[k] += 1
        # no shorter path is left, so the ends of a meeting are the last levels of both sides
        meeting = [s.where(F.col("d") == d).select("vid") for s, d in zip(sides, depth, strict=True)]
        met = checkpoint(meeting[0].join(meeting[1], "vid"))
        if met.isEmpty():
            drop_table(met)
        else:
            found = met
    tables = [nb, *sides]
    if found is None:
        for t in tables:
            drop_table(t)
        return spark.createDataFrame([], schema)
    length = depth[0] + depth[1]
    on_path = {depth[0]: found}  # by the distance from the source
    for k, step in ((0, -1), (1, 1)):
        here = found
        for d in range(depth[k] - 1, 0, -1):
            near = here.join(nb.select(F.col("src").alias("vid"), "dst"), "vid").select(F.col("dst").alias("vid")).distinct()
            here = checkpoint(near.join(sides[k].where(F.col("d") == d).select("vid"), "vid"))
            on_path[d if k == 0 else length - d] = here
    path = [a]
    for i in range(1, length):  # one value a step of the path
        path.append(nb.where(F.col("src") == path[-1]).join(on_path[i].withColumnRenamed("vid", "dst"), "dst")
                    .agg(F.min("dst")).first()[0])
    path.append(b)
    steps = spark.createDataFrame(list(enumerate(path)), "i int, vid long")
    named = graph.user_names(steps).groupBy().agg(F.array_sort(F.collect_list(F.struct("i", "user"))).alias("p"))
    out = checkpoint(named.select(
        F.lit(source).alias("source"), F.lit(target).alias("target"), (F.size("p") - 1).alias("length"),
        F.transform("p", lambda x: x["user"]).alias("path")))
    for t in {id(t): t for t in (*tables, *on_path.values())}.values():
        drop_table(t)
    return out


EDGE_KEY = ["user_from", "user_to", "action", "event_time"]
_KEY_TYPES = ["string", "string", "string", "timestamp"]


def _oriented(df: DataFrame) -> DataFrame:
    """Orientation rows (a -> b) and (b -> a) of each interaction; a self-loop once."""
    fwd = df.select(F.col("user_from").alias("a"), F.col("user_to").alias("b"), *EDGE_KEY, "dup_no")
    rev = (df.where(F.col("user_from") != F.col("user_to"))
           .select(F.col("user_to").alias("a"), F.col("user_from").alias("b"), *EDGE_KEY, "dup_no"))
    return fwd.unionByName(rev)


def ego_network(edges: DataFrame, center: str) -> DataFrame:
    """Undirected paths of one or two interactions starting at ``center``; an
    interaction never repeats inside a path, the far end may be the centre.

    Only interactions touching the centre or one of its neighbours are read.
    Identical parallel rows are distinct interactions, told apart by ``dup_no``.
    """
    e = edges.select(*EDGE_KEY).where(F.col("user_from").isNotNull() & F.col("user_to").isNotNull())
    copies = Window.partitionBy(*EDGE_KEY).orderBy(F.lit(1))
    first = e.where((F.col("user_from") == center) | (F.col("user_to") == center))
    first = checkpoint(_oriented(first.withColumn("dup_no", F.row_number().over(copies)))
                       .where(F.col("a") == center))
    nbrs = first.select(F.col("b").alias("n")).distinct()
    # interactions with at least one end among the neighbours, each exactly once
    at_from, at_to = nbrs.select(F.col("n").alias("user_from")), nbrs.select(F.col("n").alias("user_to"))
    touching = (e.join(at_from, "user_from", "left_semi").select(*EDGE_KEY)
                .unionByName(e.join(at_to, "user_to", "left_semi").join(at_from, "user_from", "left_anti").select(*EDGE_KEY)))
    second = _oriented(touching.withColumn("dup_no", F.row_number().over(copies)))
    r1 = [F.col(f"r1.{c}").alias(f"r1_{c}") for c in EDGE_KEY]
    r2 = [F.col(f"r2.{c}").alias(f"r2_{c}") for c in EDGE_KEY]
    none2 = [F.lit(None).cast(t).alias(f"r2_{c}") for c, t in zip(EDGE_KEY, _KEY_TYPES)]
    one = first.alias("r1").select(F.lit(center).alias("center"), F.lit(1).alias("hops"),
                                   F.lit(None).cast("string").alias("via"),
                                   F.col("r1.b").alias("other"), *r1, *none2)
    same = F.lit(True)
    for c in EDGE_KEY + ["dup_no"]:
        same = same & (F.col(f"r1.{c}") == F.col(f"r2.{c}"))
    two = (first.alias("r1").join(second.alias("r2"), F.col("r1.b") == F.col("r2.a"))
           .where(~same)
           .select(F.lit(center).alias("center"), F.lit(2).alias("hops"), F.col("r1.b").alias("via"),
                   F.col("r2.b").alias("other"), *r1, *r2))
    return one.unionByName(two)
