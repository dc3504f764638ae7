"""Ranked lexical search: best-first document intervals bounded by range maxima.

Terms are the maximal runs of ASCII letters, ASCII digits and characters above
U+007F in the whole text, with A-Z in small letters. A term of an item adds
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` to the score of a document, where
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and
``m = 100 - 90 + ((90 * n * N) div L)``; N counts the documents with a term, L all
their terms, n one document's, df the documents that hold the term.

Two passes. The first writes one narrow row a document: its length and the counts of
those of its terms that some item has; N, L and df are sums over that table. The
second reads it in shards of SHARD documents, as the files hold them, so no document
is shuffled. A shard keeps a posting list a term in doc_id order and, over the
impacts of each list, a sparse table of the positions of range maxima. An item's search
starts with the interval of the whole shard; the bound of an interval is the sum of its
terms' range maxima. The intervals with the highest bounds are split at the document
with the largest impact in them, which is thereby scored itself (an interval of one
document has its score as its bound), until no open interval can reach the ``k``-th
best score that the task has seen, in this shard or an earlier one. Each task returns
at most ``k`` rows an item, and a ranking by item merges them.

Scale: an item block of at most BLOCK_BYTES of text is broadcast (as its terms); more
items take more blocks, each two passes over the documents. Blocks are dealt by id and text.

Edge cases: null and empty texts have no terms, are not counted in N and are never
found; an item without terms has no rows; repeated documents are ranked one by
one; repeated rows of an item (same id and text) are one item; of equal scores the
smaller doc_id is first, a null doc_id last; a null item_id is an item like any
other; an empty table on either side gives an empty result; other columns are never
read; texts are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import materialize, observation

SHARD = 4096
BATCH = 64  # intervals that are split at a time
BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(0x20 if c in _SEPARATORS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a text in UTF-8, with repeats."""
    return (text or b"").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Items:
    """One block of items: ids, the numbers of each item's distinct terms, all terms."""

    ids: list
    terms: list[np.ndarray]
    numbers: dict[bytes, int]


def build_items(rows: list[tuple]) -> Items:
    numbers: dict[bytes, int] = {}
    ids, terms = [], []
    for item_id, text in rows:
        own = {numbers.setdefault(t, len(numbers)) for t in terms_of(text)}
        if own:
            ids.append(item_id)
            terms.append(np.array(sorted(own), np.int64))
    return Items(ids, terms, numbers)


class Postings:
    """Posting lists of one shard (documents numbered in doc_id order) with their range maxima."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int):
        order = np.lexsort((doc, term))
        self.docs = docs
        self.key = term[order] * (docs + 1) + doc[order]
        self.doc, self.impact = doc[order], impact[order]
        at = np.arange(len(order), dtype=np.int32)
        # a row above another holds the maxima of twice the length; a range never leaves its list
        self.tables = [at]
        longest = int(np.bincount(term).max()) if len(term) else 0
        while 2 << (len(self.tables) - 1) <= longest:
            last, half = self.tables[-1], 1 << (len(self.tables) - 1)
            other = np.concatenate([last[half:], last[-half:]])
            self.tables.append(np.where(self.impact[other] > self.impact[last], other, last))
        self.stack = np.stack(self.tables) if len(at) else np.zeros((1, 0), np.int32)

    def maxima(self, terms: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact (0 if there is none) and its posting, of each interval [lo, hi) and term."""
        base = terms[None, :] * (self.docs + 1)
        a = np.searchsorted(self.key, base + lo[:, None])
        b = np.searchsorted(self.key, base + hi[:, None])
        size = b - a
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        a = np.where(some, a, 0)
        left = self.stack[level, a]
        right = self.stack[level, np.where(some, b - (1 << level), 0)]
        best = np.where(self.impact[right] > self.impact[left], right, left)
        return np.where(some, self.impact[best], 0), best


class Best:
    """The ``k`` best (score, doc_id) so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]

    def open(self, bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether an interval with this bound, whose smallest id is ``first``, can hold a better one."""
        if len(self.score) < self.k:
            return bound > 0
        return (bound > self.score[-1]) | (bound == self.score[-1]) & (bound > 0) & (first < self.ids[-1])


def search(postings: Postings, ids: np.ndarray, terms: np.ndarray, best: Best) -> None:
    """Bring ``best`` up to date with the documents of a shard (``ids`` ascending)."""
    if not len(postings.key) or not postings.docs:
        return
    at = np.searchsorted(postings.key, terms * (postings.docs + 1))
    there = at < len(postings.key)
    terms = terms[there][postings.key[at[there]] < (terms[there] + 1) * (postings.docs + 1)]
    if not len(terms):
        return

    def bounded(lo, hi):
        values, where = postings.maxima(terms, lo, hi)
        top = values.argmax(1)
        return values.sum(1), postings.doc[where[np.arange(len(lo)), top]]

    lo, hi = np.array([0]), np.array([postings.docs])
    bound, split = bounded(lo, hi)
    while True:
        live = best.open(bound, ids[lo])
        lo, hi, bound, split = lo[live], hi[live], bound[live], split[live]
        if not len(lo):
            return
        if len(lo) > BATCH:
            chosen = np.zeros(len(lo), bool)
            chosen[np.argpartition(-bound, BATCH)[:BATCH]] = True
        else:
            chosen = np.ones(len(lo), bool)
        a, b, d = lo[chosen], hi[chosen], split[chosen]
        values, _ = postings.maxima(terms, d, d + 1)
        best.add(values.sum(1), ids[d])
        left, right = np.concatenate([a, d + 1]), np.concatenate([d, b])
        some = left < right
        left, right = left[some], right[some]
        new = bounded(left, right) if len(left) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        lo, hi = np.concatenate([lo[~chosen], left]), np.concatenate([hi[~chosen], right])
        bound, split = np.concatenate([bound[~chosen], new[0]]), np.concatenate([split[~chosen], new[1]])


def term_counts(docs: DataFrame, items) -> DataFrame:
    """doc_id, n (its terms, with repeats), terms and tfs (of the items' terms) of every document."""
    def run(batches):
        get = items.value.numbers.get
        size = max(1, len(items.value.numbers))
        for b in batches:
            n, keys = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                all_ = terms_of(text)
                n.append(len(all_))
                own = [x for x in map(get, all_) if x is not None]
                keys.append(np.array(own, np.int64) + k * size)
            key, tf = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            ends = np.searchsorted(key, np.arange(len(n) + 1) * size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((key % size).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int64)))],
                ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def best_documents(counts: DataFrame, items, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item, item_id, doc_id, score: at most ``k`` rows of each item from each task."""
    def run(batches):
        block, w = items.value, weights.value
        best = [Best(k) for _ in block.ids]
        held: list[tuple] = []
        size = 0

        def solve():
            ids, n = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            lengths = np.concatenate([h[2] for h in held])
            term, tf = (np.concatenate([h[i] for h in held]).astype(np.int64) for i in (3, 4))
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            owner = np.repeat(np.arange(len(ids)), lengths)
            impact = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
            postings = Postings(term, place[owner], impact, len(ids))
            for own, b in zip(block.terms, best, strict=True):
                search(postings, ids[order], own, b)

        for b in batches:
            ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            n = b.column(1).to_numpy(zero_copy_only=False)
            lists, tfs = b.column(2), b.column(3)
            lengths = np.diff(lists.offsets.to_numpy())
            held.append((ids, n, lengths, lists.flatten().to_numpy(zero_copy_only=False),
                         tfs.flatten().to_numpy(zero_copy_only=False)))
            size += len(ids)
            if size >= SHARD:
                solve()
                held, size = [], 0
        if size:
            solve()
        rows = [(i, e, d if d != NO_ID else None, s) for i, (e, b) in enumerate(zip(block.ids, best, strict=True))
                for d, s in zip(b.ids.tolist(), b.score.tolist(), strict=True)]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("item", "item_id", "doc_id", "score"), r, strict=True)) for r in rows],
            pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return counts.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search_block(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame:
    """item_id, rank, doc_id, score of one block of items."""
    spark = docs.sparkSession
    block = build_items(rows)
    items = spark.sparkContext.broadcast(block)
    counts, total = materialize(term_counts(docs, items), "term-counts", (
        observation("terms"), F.count_if(F.col("n") > 0).alias("docs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("terms")))
    # one row a term of the block
    df = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = spark.sparkContext.broadcast(np.array(
        [weight(total["docs"], df.get(t, 0)) for t in range(len(block.numbers))], np.int64))
    found = best_documents(counts, items, weights, total["docs"], max(1, total["terms"]), k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` best documents of each item."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"),
                        items["text"].cast("binary").alias("text")).where(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_BYTES) if size > BLOCK_BYTES else 1)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        own = dealt.where(F.col("block") == b).orderBy("item_id", "text")
        found.append(search_block(docs, [(r.item_id, bytes(r.text)) for r in own.collect()], k))
    return reduce(DataFrame.unionAll, found)
