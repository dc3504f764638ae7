"""SimHash near-duplicates, searched with BK-trees.

Fingerprint: words of the text in small ASCII letters, shingles of ``shingle`` words
joined by a space (the whole sequence where there are fewer), XXH64 of each with
seed 42; a bit is 1 if it is set in over half the hashes, repeats included. A text
without words has fingerprint 0.

Search: equal fingerprints are one node. Fingerprints are dealt to shards such that
two within ``radius`` bits meet in one at least: the 64 bits are cut into ``blocks``
blocks, and as ``radius`` changed bits leave ``blocks - radius`` blocks untouched, a
shard is a choice of so many blocks with their value. Each shard becomes a BK-tree
in the task that holds it: a child hangs from its parent by their integer distance,
and a search follows only the edges within the radius. (Shard trees travel in the
shuffle, as all trees together grow with the corpus and have no bound to broadcast
them under.) A shard returns the spanning links of its groups, never all pairs; a
branch that lies wholly in the component of the searched fingerprint is skipped,
which keeps dense groups near linear. Links are joined by distributed components.

Scale: the rows shuffled are distinct fingerprints times the number of block
choices. Shards above SHARD rows are cut into tiles that meet pair by pair, so no
task holds more than two tiles. The number of blocks follows the counted
fingerprints and changes only the work, never the links.

Edge cases: null, empty and blank texts have fingerprint 0 and are linked like any
other; repeated rows share their fingerprint and component; a null doc_id is kept
and never becomes a component's id unless the component has no other; texts are
read whole; unrelated texts without a doc_id, or with the same one, share a
component_id but stay apart in ``keep_one``; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import col, fresh, small_side
from plexus.llm.components import components
from plexus.session import materialize

SHARD = 20_000
FILL = 64  # fingerprints that a shard holds at most on average


def fingerprint(text: str, shingle: int) -> int:
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1:].tolist() or [len(line)]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[a:b], 42) for a, b in zip(starts, last, strict=False)], "<u8")
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    out = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(out.view("<u8")[0])


class BKTree:
    """Integers under the Hamming distance, with their components so far."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []  # union-find
        self.whole: list[bool] = []  # the branch below lies in one component

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def within(self, value: int) -> list[int]:
        """All stored values within the radius."""
        found, todo, r = [], [0] if self.values else [], self.radius
        while todo:
            n = todo.pop()
            d = (self.values[n] ^ value).bit_count()
            if d <= r:
                found.append(self.values[n])
            todo += [c for e, c in self.children[n].items() if d - r <= e <= d + r]
        return found

    def add(self, value: int) -> None:
        """Link a value to all components within the radius, then store it."""
        me = len(self.values)
        self.parent.append(me)
        todo, r = [0] if me else [], self.radius
        while todo:
            n = todo.pop()
            if self.whole[n] and self.root(n) == self.root(me):
                continue
            d = (self.values[n] ^ value).bit_count()
            if d <= r:
                a, b = self.root(n), self.root(me)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
            todo += [c for e, c in self.children[n].items() if d - r <= e <= d + r]
        self.values.append(value)
        self.children.append({})
        self.whole.append(True)
        n = 0
        while n != me:
            if self.whole[n] and self.root(n) != self.root(me):
                self.whole[n] = False
            n = self.children[n].setdefault((self.values[n] ^ value).bit_count(), me)


def links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning links (value, first value of its component) of one shard."""
    tree = BKTree(radius)
    for v in values:
        tree.add(v)
    roots = [tree.root(i) for i in range(len(values))]
    return [(values[i], values[r]) for i, r in enumerate(roots) if i != r]


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th (a hash of the text, to name a row again) and fp (as a signed long)."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t or "", shingle) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("th"),
                       docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def shard_masks(count: int, radius: int) -> list[int]:
    """Bit masks of the shards for so many fingerprints."""
    blocks = radius + 2
    while blocks < 16 and count / 2 ** (64 * (blocks - radius) / blocks) > FILL:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def near_links(values: DataFrame, radius: int) -> DataFrame:
    """Spanning links (u, v) of distinct fingerprints ``fp`` within ``radius`` bits."""
    masks = [m - (1 << 64) if m >> 63 else m for m in shard_masks(values.count(), radius)]
    dealt = values.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "part"))
    sizes = dealt.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n"))
    # a shard of one has no links; the rest is joined back only where it is large
    large = sizes.where(F.col("n") > SHARD).select(
        "mask", "part", F.ceil(F.col("n") / SHARD).cast("int").alias("tiles"))
    dealt = dealt.join(small_side(large, "large-shards"), ["mask", "part"], "left")
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.withColumn("tile", F.coalesce(tile, F.lit(0))).withColumn("other", other).select(
        "mask", "part", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "fp")
    keys = ["mask", "part", "a", "b"]

    def run(batches):
        rest = None  # the last run of a batch may go on in the next

        def solve(key, fp, done):
            change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            first = np.concatenate([[0], change])
            size = np.diff(np.concatenate([first, [len(fp)]]))
            held = first[-1] if not done else len(fp)
            out = []
            for f, n in zip(first.tolist(), size.tolist(), strict=True):
                if n > 1 and f < held:
                    out += links(fp[f:f + n].view(np.uint64).tolist(), radius)
            uv = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return uv, (key[held:], fp[held:])

        for b in batches:
            key = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
            fp = b.column(4).to_numpy(zero_copy_only=False)
            if rest is not None:
                key, fp = np.concatenate([rest[0], key]), np.concatenate([rest[1], fp])
            if len(fp):
                uv, rest = solve(key, fp, False)
                yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], ["u", "v"])
        if rest is not None and len(rest[1]):
            uv, _ = solve(*rest, True)
            yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], ["u", "v"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long")


def rooted_fingerprints(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, th, fp of every row; fp, lead (its smallest doc_id), root (the fingerprint that
    names its component) of every distinct fingerprint."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    values = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("lead")), "distinct-fingerprints")
    roots = components(near_links(values.select("fp"), radius))
    return rows, materialize(values.join(roots, values["fp"] == roots["node"], "left").select(
        "fp", "lead", F.coalesce("root", "fp").alias("root")), "rooted-fingerprints")


def groups(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, th, fp, component_id of every row."""
    rows, rooted = rooted_fingerprints(docs, shingle, radius)
    # written, so that both sides of the join are shuffles that a large group can be split in
    least = materialize(rooted.groupBy("root").agg(F.min("lead").alias("component_id")), "component-ids")
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-groups")
    return rows.join(named, "fp").select("doc_id", "th", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable)."""
    return groups(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group, all columns as they came: the one with the smallest doc_id
    (of several with that doc_id, the one whose text hash is smallest). Groups are told
    apart by their root, as component ids may be null or shared by unrelated texts."""
    rows, rooted = rooted_fingerprints(docs, shingle, radius)
    first = rows.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("th"))).alias("x"))
    i, h = fresh(docs, "_id"), fresh(docs, "_text_hash")
    keep = first.select(F.col("x.doc_id").alias(i), F.col("x.th").alias(h)).distinct()
    tagged = docs.withColumns({i: docs["doc_id"].cast("long"), h: F.xxhash64(docs["text"])})
    left = tagged.alias("l").join(keep.alias("r"), (F.col(f"l.{i}").eqNullSafe(F.col(f"r.{i}")))
                                  & (F.col(f"l.{h}") == F.col(f"r.{h}")), "left_semi")
    once = left.dropDuplicates([i, h])
    return once.select(*[col(once, c) for c in docs.columns])
