"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and ``_`` in small letters. A seed is three words of a
test item in order, next to each other or with a word or two left out (SHAPES); a text
holds the seed if it has the three words in any of these shapes, so a replaced, added
or dropped word between them does no harm. Items of less than SHORT words have pairs of
words for seeds too; items of less than WHOLE words count only as whole copies. Hits on nearby
diagonals make a window (two hits at least, unless the item is short), and the window
is aligned with the item by Smith-Waterman over words (match 2, mismatch and gap -1).
A document is contaminated if the best score reaches ``least`` of the score of a whole
copy, so edited and paraphrased copies count as well as exact ones. Every pair
reported has been aligned; ``tests/llm`` measures how many of the pairs that an
alignment of every document with every item accepts are found.

Rare: a first pass counts all seeds over the whole corpus. A seed is left out only if it
is COMMON times as frequent as the median seed of its item, and more frequent than a
RARE share of the corpus' words, and not among the rarest KEEP of its stretch of the
item. So phrases of the language go, an item that was copied thousands of times
keeps its seeds, and a larger corpus of the same kind keeps the same seeds. Before the
alignment, windows that cannot reach the score (too few words in common) are passed
over; that bound is exact.

Scale: both passes are narrow, no text is shuffled, and a passage that a third of
all documents share costs each of them its own alignment. A window is at most
8 item lengths: a longer stretch is cut with an overlap that no accepted alignment exceeds. The seed
index of one block of items is broadcast as flat arrays; a block has about BLOCK_WORDS
words, and a larger benchmark takes more blocks, each two passes over the documents.

Edge cases: null and empty texts and items have no words and never match; repeated
documents are reported one by one, repeated items by their own ids; ties between
windows go to the first; texts are read whole; empty tables give an empty result;
other columns are never read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHAPES = ((1, 2), (1, 3), (2, 3), (2, 4))  # places of the second and third word after the first
PAIRS = (1, 2, 3)  # places of the second word of a pair
WHOLE = 4
SHORT = 12
COMMON = 50
RARE = 1e-6
STRETCH, KEEP = 8, 6
LEAST = 0.5
MATCH, MISS = 2, -1
BLOCK_WORDS = 500_000
FILTER_BITS = 22
WORDS = -1
CELLS = 1 << 22  # of an alignment batch

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Index:
    """Words and seeds of one block of items. Seed ``s`` has the code ``codes[s]`` (ascending) and
    the owners ``item[k]``, ``place[k]`` for k in first[s] .. first[s + 1]."""

    item_ids: list
    items: list[np.ndarray]  # word numbers from 1
    sizes: np.ndarray
    vocabulary: dict[str, int]
    codes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    lengths: tuple[int, ...]  # words of the seeds there are
    bits: np.ndarray  # a filter of the codes

    def encode(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        w = words_of(text)
        return np.fromiter((get(x, 0) for x in w), np.int64, len(w))


def _spot(code: np.ndarray) -> np.ndarray:
    x = code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _codes(w: np.ndarray, base: int, length: int):
    """(codes, places) of the seeds of ``length`` known words, shape by shape. Codes of different lengths differ."""
    if length == 3:
        for a, b in SHAPES:
            m = len(w) - b
            if m > 0:
                at = np.flatnonzero((w[:m] > 0) & (w[a:a + m] > 0) & (w[b:] > 0))
                yield (w[at] * base + w[at + a]) * base + w[at + b], at
    elif length == 2:
        for a in PAIRS:
            m = len(w) - a
            if m > 0:
                at = np.flatnonzero((w[:m] > 0) & (w[a:] > 0))
                yield (w[at] * base + w[at + a]) * base, at
    else:
        at = np.flatnonzero(w > 0)
        yield w[at] * base * base, at


def _indexed(item_ids, items, vocabulary, code, item, place) -> Index:
    order = np.lexsort((place, item, code))
    code, item, place = code[order], item[order], place[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1])
    code, item, place = code[new], item[new], place[new]
    codes, first = np.unique(code, return_index=True)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[_spot(codes)] = True
    base = len(vocabulary) + 1
    lengths = tuple(k for k, some in ((3, codes % base > 0), (2, (codes % base == 0) & (codes // base % base > 0)),
                                      (1, codes % (base * base) == 0)) if some.any())
    return Index(item_ids, items, np.array([len(w) for w in items], np.int64), vocabulary, codes,
                 np.append(first, len(code)), item, place, lengths, bits)


def build_index(rows: list[tuple[int, str]]) -> Index:
    vocabulary: dict[str, int] = {}
    ids, items = [], []
    for i, text in rows:
        w = words_of(text or "")
        if w:
            ids.append(i)
            items.append(np.array([vocabulary.setdefault(x, len(vocabulary) + 1) for x in w], np.int64))
    base = len(vocabulary) + 1  # of one block: its cube fits 64 bits
    code, item, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, w in enumerate(items):
        # a whole copy of a very short item has its first words in a row
        lengths = (3, 2) if WHOLE <= len(w) < SHORT else (min(3, len(w)),)
        for n in lengths:
            for c, at in _codes(w, base, n):
                code.append(c)
                item.append(np.full(len(c), k))
                place.append(at)
    return _indexed(ids, items, vocabulary, *(np.concatenate(x).astype(np.int64) for x in (code, item, place)))


def _hits(index: Index, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed numbers and places of the words of texts (0 between texts)."""
    seeds, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    base = len(index.vocabulary) + 1
    for n in index.lengths:
        for code, at in _codes(w, base, n):
            maybe = index.bits[_spot(code)]
            code, at = code[maybe], at[maybe]
            k = np.minimum(np.searchsorted(index.codes, code), len(index.codes) - 1)
            same = index.codes[k] == code
            seeds.append(k[same])
            places.append(at[same])
    return np.concatenate(seeds), np.concatenate(places)


def rare_only(index: Index, counts: np.ndarray, words: int) -> Index:
    """The index without the seeds that are common next to their item's median seed, in a corpus of
    so many words; the rarest of each stretch stay in any case."""
    seed = np.repeat(np.arange(len(index.codes)), np.diff(index.first))
    n = counts[seed]
    order = np.lexsort((n, index.item))
    edges = np.searchsorted(index.item[order], np.arange(len(index.items) + 1))
    middle = n[order][np.minimum((edges[:-1] + edges[1:]) // 2, max(0, len(n) - 1))] if len(n) else np.zeros(len(index.items))
    keep = (n <= COMMON * np.maximum(1, middle)[index.item]) | (n <= RARE * words)
    part = index.item * (1 << 32) + index.place // STRETCH
    order = np.lexsort((n, part))
    start = np.searchsorted(part[order], part[order])
    keep[order[np.arange(len(order)) - start < KEEP]] = True
    return _indexed(index.item_ids, index.items, index.vocabulary, index.codes[seed][keep], index.item[keep], index.place[keep])


def _joined(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers of texts with gaps of 0 that no seed can span, and where each begins."""
    gap = np.zeros(max(b for _, b in SHAPES) + 1, np.int64)
    starts = np.cumsum([0, *(len(a) + len(gap) for a in arrays)])
    return np.concatenate([x for a in arrays for x in (a, gap)]) if arrays else gap, starts


def windows(index: Index, arrays: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int, int, int]]:
    """(text, item, from, to) of the places of texts (their word numbers) that share seeds with an item."""
    w, starts = _joined(arrays)
    if not len(index.codes):
        return []
    seed, at = _hits(index, w)
    n = np.diff(index.first)[seed]
    own = np.repeat(index.first[seed], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, item = np.repeat(at, n), index.item[own]
    text = np.searchsorted(starts, at, "right") - 1
    at = at - starts[text]
    diagonal = at - index.place[own]
    order = np.lexsort((at, diagonal, item, text))
    text, item, diagonal, at = text[order], item[order], diagonal[order], at[order]
    size = index.sizes[item]
    new = np.ones(len(at), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > size[1:])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    out = []
    if not len(begin):
        return out
    low, high = np.minimum.reduceat(at, begin), np.maximum.reduceat(at, begin)
    for a, z, one in zip(begin.tolist(), end.tolist(), (low == high).tolist(), strict=True):
        t, i, s = int(text[a]), int(item[a]), int(size[a])
        if one and s >= SHORT:
            continue
        margin = s // 4 + 4
        x, y = max(0, int(diagonal[a]) - margin), min(len(arrays[t]), int(diagonal[z - 1]) + s + margin)
        step = 6 * s + 8
        while True:
            stop = min(y, x + step + 2 * s)
            common = np.isin(arrays[t][x:stop], index.items[i])
            wanted = least if s >= WHOLE else 1.0
            if min(int(common.sum()), s) >= wanted * s:
                out.append((t, i, x, stop))
            if stop == y:
                break
            x += step
    return out


def best_scores(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smith-Waterman scores of (window, item) pairs, all at once.

    One step takes one window word of every pair. Inside a row a gap costs 1 a word, so
    the best way to come from the left is a running maximum of score + column."""
    scores = np.zeros(len(pairs), np.int32)
    order = np.argsort([-len(a) for a, _ in pairs], kind="stable")
    k = 0
    while k < len(order):
        longest = max(1, len(pairs[order[k]][0]))
        part = order[k:k + max(1, min(512, CELLS // longest))]
        k += len(part)
        long, wide = len(pairs[part[0]][0]), max(len(pairs[i][1]) for i in part)
        text, item = np.full((len(part), long), -1, np.int32), np.full((len(part), wide), -2, np.int32)
        for r, i in enumerate(part):
            a, b = pairs[i]
            text[r, :len(a)], item[r, :len(b)] = np.where(a > 0, a, -1), b
        sizes = np.array([len(pairs[i][0]) for i in part])
        h, best = np.zeros((len(part), wide + 1), np.int32), np.zeros(len(part), np.int32)
        column = np.arange(wide + 1, dtype=np.int32)
        for t in range(long):
            n = int(np.searchsorted(-sizes, -t, "left"))  # pairs whose window is longer than t
            prev = h[:n]
            diag = prev[:, :-1] + np.where(item[:n] == text[:n, t:t + 1], MATCH, MISS).astype(np.int32)
            row = np.zeros_like(prev)
            row[:, 1:] = np.maximum(np.maximum(diag, prev[:, 1:] + MISS), 0)
            row = np.maximum.accumulate(row + column, axis=1) - column
            h[:n] = row
            best[:n] = np.maximum(best[:n], row.max(1))
        scores[part] = best
    return scores


def align(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Score and the aligned range [from, to) of ``a``; the earliest of equal ends."""
    prev, start = [0] * (len(b) + 1), [0] * (len(b) + 1)
    best = (0, 0, 0)
    for i, x in enumerate(a):
        row, begin = [0], [i + 1]
        for j, y in enumerate(b):
            d = prev[j] + (MATCH if x == y else MISS)
            u, left = prev[j + 1] + MISS, row[j] + MISS
            v = max(d, u, left)
            if v <= 0:
                row.append(0)
                begin.append(i + 1)
                continue
            row.append(v)
            begin.append(start[j] if v == d and prev[j] > 0 else i if v == d else start[j + 1] if v == u else begin[j])
            if v > best[0]:
                best = (v, begin[-1], i + 1)
        prev, start = row, begin
    return best


def find(index: Index, texts: list[str], least: float) -> list[tuple[int, int, float, int, int]]:
    """(text number, item number, score, start, end) of every contaminated pair, offsets in characters."""
    arrays = [index.encode(t) if t else np.zeros(0, np.int64) for t in texts]
    todo = windows(index, arrays, least)
    pairs = [(arrays[t][a:b], index.items[i]) for t, i, a, b in todo]
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for (t, item, a, b), (_, y), s in zip(todo, pairs, best_scores(pairs).tolist(), strict=True):
        share = s / (MATCH * len(y))
        if share >= (least if len(y) >= WHOLE else 1.0) and share > best.get((t, item), (0.0,))[0]:
            best[t, item] = (share, a, b)
    out, spans = [], {}
    for (t, item), (share, a, b) in sorted(best.items()):
        if spans.get("of") != t:
            spans = {"of": t, "at": [m.span() for m in _WORD.finditer(texts[t].lower())]}
        _, x, y = align([v or -1 for v in arrays[t][a:b].tolist()], index.items[item].tolist())
        at = spans["at"]
        out.append((t, item, share, at[a + x][0], at[a + y - 1][1]))
    return out


def _indexes(docs: DataFrame, items: DataFrame):
    """A broadcast index of rare seeds for each block of items."""
    spark = docs.sparkSession
    rows = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].alias("text"))
    # a word has at least one character and one after it
    size = rows.select(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = int(size // BLOCK_WORDS) + 1
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = build_index([tuple(r) for r in part.collect()])  # one block, of bounded size
        if not index.items:
            continue
        shared = spark.sparkContext.broadcast(index)
        hits = dict(seed_counts(docs, shared).collect())  # one row a seed
        words = hits.pop(WORDS, 0)
        counts = np.zeros(len(index.codes), np.int64)
        counts[list(hits)] = list(hits.values())
        yield spark.sparkContext.broadcast(rare_only(index, counts, words))


def seed_counts(docs: DataFrame, shared) -> DataFrame:
    """seed, hits: how often each seed occurs in all documents (seeds that do), and the number of
    the corpus' words under WORDS."""
    def run(batches):
        index = shared.value
        total, size = np.zeros(len(index.codes), np.int64), 0
        for b in batches:
            arrays = [index.encode(t) for t in b.column(0).to_pylist() if t]
            size += sum(len(a) for a in arrays)
            total += np.bincount(_hits(index, _joined(arrays)[0])[0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"seed": pa.array(np.append(at, WORDS), pa.int64()),
                                          "hits": pa.array(np.append(total[at], size), pa.int64())})

    rows = docs.select(docs["text"].alias("text")).mapInArrow(run, "seed long, hits long")
    return rows.groupBy("seed").agg(F.sum("hits").alias("hits"))


def contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score, start, end: the best alignment of every contaminated pair."""
    schema = "doc_id long, item_id long, score double, start long, end long"
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))

    def search(shared) -> DataFrame:
        def run(batches):
            index = shared.value
            for b in batches:
                ids = b.column(0).to_pylist()
                found = find(index, b.column(1).to_pylist(), least)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([ids[f[0]] for f in found], pa.int64()),
                    "item_id": pa.array([index.item_ids[f[1]] for f in found], pa.int64()),
                    "score": pa.array([f[2] for f in found], pa.float64()),
                    "start": pa.array([f[3] for f in found], pa.int64()),
                    "end": pa.array([f[4] for f in found], pa.int64())})

        return rows.mapInArrow(run, schema)

    parts = [search(shared) for shared in _indexes(docs, items)]
    return reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def keep_clean(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they came."""
    text = docs.columns.index("text")
    for shared in _indexes(docs, items):
        def run(batches, shared=shared):
            for b in batches:
                bad = {f[0] for f in find(shared.value, b.column(text).to_pylist(), least)}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
