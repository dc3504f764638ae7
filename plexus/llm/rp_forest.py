"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Each tree splits the vectors level by level at the median of their projection on
a random direction (one a level). For the inner product, vectors are given one
more component that makes all norms equal and a query gets 0 there, so that the
largest product is the smallest angle. A query walks all trees through one
priority queue: the subtree that leaves the query's side by the least (squared
margins summed on the way down) is opened next, whatever its tree, until ``budget``
leaves are reached. The rows of those leaves are reranked by the exact product in double precision.

Fit: directions are random, split points are medians over the SAMPLE vectors with
the smallest id hashes; all other vectors are routed through them and indexed. The
budget is measured, not set: CALIBRATE queries are answered exactly over all
vectors, and the budget is the least number of leaves at which ``target`` of their
neighbours are reached. Data with structure needs few leaves; data without (random
directions) needs a large share of them.

Scale: equal vectors are one row, which keeps their ``k + 1`` smallest ids (no answer
can need another). Rows and visits are dealt by (tree, leaf); a leaf of over CHUNK
rows is cut into chunks that each visit is sent to, and a leaf that over VISITS
queries visit has its rows sent to as many tasks, so no task holds a hot leaf. A
task keeps the ``k + 1`` best of a query over all its leaves. The model (split points
and row counts of at most TREES * MAX_LEAVES leaves) is all that is broadcast.

Edge cases: a vector that is null, empty, zero or holds a null or non-finite component
takes no part, nor does a row without an id; if vectors differ in length, only
those of the most frequent length (the longest of several) take part; of a
repeated id the smallest vector counts; equal products
go to the smaller id; fewer candidates than ``k`` are all returned; an empty table
gives an empty result; other columns are never read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import materialize, observation

TREES = 10
LEAF = 256  # rows of a leaf that the depth aims at
MAX_LEAVES = 4096
SAMPLE = 32_768
SAMPLE_BYTES = 64 << 20
CALIBRATE = 64
TARGET = 0.96
CHUNK = 2048
VISITS = 50_000
SALT = 16
SEED = 7

@dataclass
class Forest:
    """directions: tree x level x dimension + 1; splits: tree x inner node (heap order)."""

    directions: np.ndarray
    splits: np.ndarray
    norm2: float  # of the longest vector
    budget: int = 0
    sizes: np.ndarray | None = None  # rows by tree and leaf

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def projected(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """tree x level x row: projections of the extended vectors."""
        if queries:
            length = np.sqrt((vectors ** 2).sum(1, keepdims=True))
            whole = np.concatenate([vectors / length, np.zeros((len(vectors), 1))], 1)
        else:
            scaled = vectors / np.sqrt(self.norm2)
            rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled ** 2).sum(1, keepdims=True)))
            whole = np.concatenate([scaled, rest], 1)
        return self.directions @ whole.T

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """tree x row: the leaf of each indexed vector."""
        p = self.projected(vectors, False)
        node = np.zeros((p.shape[0], p.shape[2]), np.int64)
        for level in range(self.depth):
            node = 2 * node + 1 + (p[:, level] >= np.take_along_axis(self.splits, node, 1))
        return node - (2 ** self.depth - 1)

    def visits(self, projections: np.ndarray, budget: int) -> list[tuple[int, int]]:
        """(tree, leaf) of the ``budget`` nearest leaves of all trees, nearest first."""
        inner = 2 ** self.depth - 1
        queue = [(0.0, t, 0, 0) for t in range(len(self.splits))]
        out = []
        margins, splits = projections.tolist(), self.splits
        while queue and len(out) < budget:
            cost, t, node, level = heapq.heappop(queue)
            while node < inner:  # the nearer child costs nothing more
                m = margins[t][level] - float(splits[t, node])
                near = 2 * node + 1 + (m >= 0)
                far = 4 * node + 3 - near
                heapq.heappush(queue, (cost + m * m, t, far, level + 1))
                node, level = near, level + 1
            out.append((t, node - inner))
        return out


def fit(sample: np.ndarray, norm2: float, rows: int, trees: int = TREES, leaf: int = LEAF) -> Forest:
    """Trees whose leaves hold about ``leaf`` of ``rows`` vectors, split at the medians of the sample."""
    leaves = min(MAX_LEAVES, max(1, rows // leaf), max(1, len(sample) // 8))
    depth = int(np.log2(leaves))
    trees = trees if depth else 1
    rng = np.random.default_rng(SEED)
    forest = Forest(rng.standard_normal((trees, depth, sample.shape[1] + 1)), np.zeros((trees, max(1, 2 ** depth - 1))), norm2)
    if not depth:
        return forest
    forest.directions /= np.sqrt((forest.directions ** 2).sum(2, keepdims=True))
    p = forest.projected(sample, False)
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            first = 2 ** level - 1
            order = np.lexsort((p[t, level], node))
            edges = np.searchsorted(node[order], np.arange(first, 2 * first + 2))
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if a < b:
                    forest.splits[t, first + k] = np.median(p[t, level][order[a:b]])
            node = 2 * node + 1 + (p[t, level] >= forest.splits[t][node])
    return forest


def _matrix(column, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _lists(vectors: np.ndarray, kind: str) -> pa.ListArray:
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel().astype(np.dtype(kind))))


def _columns(rows: DataFrame) -> tuple[str, str]:
    """The schema of rows dealt to cells, and numpy's name of the vectors' type (floats stay floats on the way)."""
    kind = rows.schema["vector"].dataType.elementType.simpleString()
    return f"cell long, side int, id long, vector array<{kind}>", {"float": "f4"}.get(kind, "f8")


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """id, vector (floats as they are, else doubles) of the rows that take part, before the choice of a length."""
    v = F.col("vector")
    kind = "array<float>" if table.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.select(table["vec_id"].cast("long").alias("id"), table[vector].cast(kind).alias("vector")).where(
        F.col("id").isNotNull() & fine & F.exists(v, lambda x: x != 0))


def _least(rows: DataFrame, key: Column, k: int) -> DataFrame:
    """The ``k`` smallest ids of each key, first among SALT parts of a key's rows."""
    parts = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)))
    for by in ([key, F.col("salt")], [key]):
        place = Window.partitionBy(*by).orderBy("id")
        parts = parts.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k).drop("place")
    return parts.drop("salt")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """id (the smallest), ids (the ``k + 1`` smallest), vector: one row a different vector."""
    few = _least(rows.groupBy("id").agg(F.min("vector").alias("vector")), F.col("vector"), k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("id"), "ids", "vector")


def _best(query: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """The ``k`` best different (score, id) of each query."""
    order = np.lexsort((other, -score, query))
    query, other, score = query[order], other[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (other[1:] != other[:-1]) | (score[1:] != score[:-1])
    query, other, score = query[new], other[new], score[new]
    first = np.concatenate([[0], np.flatnonzero(query[1:] != query[:-1]) + 1]) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.concatenate([first, [len(query)]])))
    top = place < k
    return query[top], other[top], score[top]


def products(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, product) of at least the ``k`` rows with the largest products with each query."""
    rough = queries @ rows.T
    if rows.shape[0] > k:
        last = -np.partition(-rough, k - 1, 1)[:, k - 1:k]
        # products that may be equal but for the order of their sums
        q, r = np.nonzero(rough >= last - 1e-12 * np.abs(last))
    else:
        q, r = (x.ravel() for x in np.indices(rough.shape))
    # one fixed order of summation, so that a pair has the same product in every leaf
    return q, r, (queries[q] * rows[r]).sum(1)


def _scored(batches, dimension: int, k: int):
    """Products within cells: batches of (cell, side, id, vector), sorted, rows (side 0) before visits."""
    held: list[tuple] = []
    pending = 0
    cell, ids, rows = None, [], []

    def joined():
        nonlocal held
        q, o, s = _best(*(np.concatenate(x) for x in zip(*held, strict=True)), k)
        held = [(q, o, s)]
        return len(q)

    for b in batches:
        cells, sides, names = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        vectors = _matrix(b.column(3), dimension)
        runs = np.flatnonzero((cells[1:] != cells[:-1]) | (sides[1:] != sides[:-1])) + 1
        for a, z in zip([0, *runs.tolist()], [*runs.tolist(), len(cells)], strict=True):
            if a == z:
                continue
            if cells[a] != cell:
                cell, ids, rows = cells[a], [], []
            if sides[a] == 0:
                ids.append(names[a:z])
                rows.append(vectors[a:z])
            elif rows:
                if len(rows) > 1:
                    ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                q, r, s = products(vectors[a:z], rows[0], k)
                held.append((names[a:z][q], ids[0][r], s))
                pending += len(q)
                if pending > 1 << 21:
                    pending = min(joined(), 1 << 20)
    if held:
        joined()
        q, o, s = held[0]
        for a in range(0, len(q), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[a:a + (1 << 16)]) for x in (q, o, s)], ["query", "other", "score"])


def merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different (other, score) of each query."""
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("other"))
    return found.distinct().withColumn("place", F.row_number().over(place)).where(F.col("place") <= k).drop("place")


def exact(queries: list[tuple[int, np.ndarray]], rows: DataFrame, k: int) -> DataFrame:
    """query, other, score: the ``k`` rows with the largest products, over all rows; for a bounded list of queries."""
    dimension = len(queries[0][1])

    def run(batches):
        q = np.array([v for _, v in queries])
        names = np.array([i for i, _ in queries], np.int64)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for b in batches:
            if b.num_rows:
                i, r, s = products(q, _matrix(b.column(1), dimension), k)
                new = (names[i], b.column(0).to_numpy(zero_copy_only=False)[r], s)
                best = _best(*(np.concatenate(x) for x in zip(best, new, strict=True)), k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["query", "other", "score"])

    return merged(rows.select("id", "vector").mapInArrow(run, "query long, other long, score double"), k)


def calibrate(forest: Forest, rows: DataFrame, queries: DataFrame, k: int, target: float) -> int:
    """The least number of leaves at which ``target`` of the neighbours of CALIBRATE queries are reached."""
    chosen = [(r.id, np.array(r.vector)) for r in queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATE).collect()]
    if not chosen or not forest.depth:
        return len(forest.splits) * 2 ** forest.depth
    truth = exact(chosen, rows, k + 1).where("query <> other").join(
        rows.select(F.col("id").alias("other"), "vector"), "other").select("query", "vector").collect()
    wanted: dict[int, list] = {}
    for q, v in truth:
        wanted.setdefault(q, []).append(v)
    places = []
    for (q, v), p in zip(chosen, np.moveaxis(forest.projected(np.array([v for _, v in chosen]), True), 2, 0), strict=True):
        if q in wanted:
            order = {leaf: i for i, leaf in enumerate(forest.visits(p, len(forest.splits) * 2 ** forest.depth))}
            own = forest.leaves(np.array(wanted[q]))
            places += [min(order[t, int(leaf)] for t, leaf in enumerate(x)) for x in own.T]
    if not places:
        return len(forest.splits)
    return int(np.sort(places)[min(len(places) - 1, int(np.ceil(target * len(places))))]) + 1


def _cell(tree, leaf, chunk, copy):
    """One long of a tree, a leaf, a chunk of its rows and a copy of that chunk."""
    return (tree << 52) | (leaf << 40) | (chunk << 16) | copy


def leaf_sizes(rows: DataFrame, forest, dimension: int) -> np.ndarray:
    def run(batches):
        n = np.zeros((len(forest.value.splits), 2 ** forest.value.depth), np.int64)
        for b in batches:
            if b.num_rows:
                for t, own in enumerate(forest.value.leaves(_matrix(b.column(0), dimension))):
                    n[t] += np.bincount(own, minlength=n.shape[1])
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.ravel()[at])], ["at", "n"])

    sizes = np.zeros((len(forest.value.splits), 2 ** forest.value.depth), np.int64)
    for at, n in rows.select("vector").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        sizes.flat[at] = n
    return sizes


def visited(queries: DataFrame, forest, dimension: int) -> DataFrame:
    """cell, side 1, id, vector: a row for each chunk of each leaf that a query visits."""
    schema, kind = _columns(queries)

    def run(batches):
        f = forest.value
        chunks = -(-f.sizes // CHUNK)
        for b in batches:
            ids, vectors = b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1), dimension)
            for k, p in enumerate(np.moveaxis(f.projected(vectors, True), 2, 0)):
                cells = np.array([_cell(t, leaf, c, 0) for t, leaf in f.visits(p, f.budget) for c in range(chunks[t, leaf])], np.int64)
                for part in np.array_split(cells, len(cells) // 4096 + 1):
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(np.ones(n, np.int32)), pa.array(np.full(n, ids[k])),
                         _lists(np.broadcast_to(vectors[k], (n, dimension)), kind)], ["cell", "side", "id", "vector"])

    return queries.select("id", "vector").mapInArrow(run, schema)


def routed(rows: DataFrame, forest, dimension: int) -> DataFrame:
    """cell, side 0, id, vector: each row once a tree."""
    schema, kind = _columns(rows)

    def run(batches):
        f = forest.value
        chunks = -(-f.sizes // CHUNK)
        for b in batches:
            if not b.num_rows:
                continue
            ids, vectors = b.column(0).to_numpy(zero_copy_only=False), _matrix(b.column(1), dimension)
            spread = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64)
            for t, own in enumerate(f.leaves(vectors)):
                cells = _cell(t, own, spread % np.maximum(1, chunks[t, own]), 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells), pa.array(np.zeros(len(ids), np.int32)), pa.array(ids), _lists(vectors, kind)],
                    ["cell", "side", "id", "vector"])

    return rows.select("id", "vector").mapInArrow(run, schema)


def nearest(table: DataFrame, is_query, k: int = 20, vector: str = "embedding", trees: int = TREES,
            target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows found with the largest inner products
    with each row for which ``is_query`` (a function of the id column) holds, its own id excepted."""
    spark = table.sparkSession
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fine = usable(table, vector)
    lengths = fine.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return nothing
    dimension = int(lengths["n"])
    fine = fine.where(F.size("vector") == dimension)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows, seen = materialize(distinct_vectors(fine, k), "vectors", (
        observation("vectors"), F.count(F.lit(1)).alias("n"), F.max(square).alias("norm2")))
    asked = materialize(fine.where(is_query(F.col("id"))).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    queries = materialize(asked.groupBy("vector").agg(F.min("id").alias("id")), "query-vectors")

    bound = int(min(SAMPLE, SAMPLE_BYTES // (8 * (dimension + 1))))
    sample = np.array([r.vector for r in rows.orderBy(F.xxhash64("id"), "id").limit(bound).select("vector").collect()])
    forest = fit(sample, seen["norm2"], seen["n"], trees)
    forest.budget = calibrate(forest, rows, queries, k, target)
    forest.sizes = leaf_sizes(rows, spark.sparkContext.broadcast(forest), dimension)
    model = spark.sparkContext.broadcast(forest)

    visits = materialize(visited(queries, model, dimension), "visits")
    # one row a busy cell: at most as many as leaves and chunks
    busy = visits.groupBy("cell").count().where(F.col("count") > VISITS).select(
        "cell", F.ceil(F.col("count") / VISITS).cast("int").alias("copies"))
    placed = routed(rows, model, dimension)
    if not busy.isEmpty():
        busy = materialize(busy, "busy-cells")
        placed = placed.join(busy, "cell", "left").withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).select(
            (F.col("cell") + F.col("copy")).alias("cell"), "side", "id", "vector")
        visits = visits.join(busy, "cell", "left").select(
            (F.col("cell") + F.pmod(F.xxhash64("id"), F.coalesce("copies", F.lit(1)))).alias("cell"), "side", "id", "vector")
    pairs = placed.unionByName(visits).repartition("cell").sortWithinPartitions("cell", "side")
    found = merged(pairs.mapInArrow(lambda batches: _scored(batches, dimension, k + 1),
                                    "query long, other long, score double"), k + 1)

    # back to rows: equal vectors by their ids, each query with the answer of its vector
    copies = rows.where(F.size("ids") > 1).select(F.col("id").alias("other"), "ids")
    answers = found.join(copies, "other", "left").select(
        "query", F.explode(F.coalesce("ids", F.array("other"))).alias("vec_id"), "score")
    short = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))
    answers = answers.withColumn("place", F.row_number().over(short)).where(F.col("place") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("answer"))
    named = asked.join(queries.select("vector", F.col("id").alias("query")), "vector").select(
        F.col("id").alias("query_id"), "query")
    own = named.join(answers, "query").select("query_id", F.slice(F.filter(
        "answer", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("answer"))
    return own.select("query_id", F.posexplode("answer").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the exact neighbours (query_id, vec_id) that were found."""
    both = truth.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return both.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
