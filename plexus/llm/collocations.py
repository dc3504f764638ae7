"""Phrase collocation mining on a weighted de Bruijn graph of words.

Texts, with A-Z in small letters, are cut into pieces at ``. , ; : ! ?`` and line ends,
pieces into words at blanks and tabs; everything counts per language (null: ``und``).

The graph of the ``order``-grams (5): a node is a run of 4 words, an edge joins two
nodes that overlap in 3, its weight is the count of the 5 words. Shorter counts
are not counted again: the count of a run is its flow, the summed counts of its
one-word extensions to the right, plus the number of pieces that end with it. The
words are named by 64-bit hashes; the dictionary, which has all words, proves that
no frequent word shares its name (else another seed is taken).

A phrase counts only if it occurs ``least`` times, and then so do all its parts. Pieces
are therefore cut, exactly, at words and between pairs of words that occur less often.
The frequent words and pairs are broadcast as bit maps of fixed size: a false
positive of a map keeps a word or pair that the final counts drop.

Heavy edges (weight >= ``least``) are compacted: where a node has one heavy edge in
and one out, the two are on one unary path. Paths are found by doubling the reach of
each edge's pointer to its predecessor, a round a written table, cycles are
opened at their smallest edge, and a path longer than SEGMENT edges is stored in
segments. Edge and node counts of candidates are read off the paths; the flow into
shorter runs is that of the paths' nodes plus that of light nodes and piece ends.

Scale: words are shuffled once as distinct words a task, pairs as distinct hashes a task,
edges and flows as partial sums; no key gets more than one row a task. Paths
and candidates number at most a ``least``-th of the words. Products are decimals of 38 digits.

Edge cases: null and empty texts have no words; a null lang is ``und`` and shares it
with rows that say so; repeated rows count each time; words are read whole whatever
their length; ties end in the phrase's UTF-8 bytes; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import small_side
from plexus.session import materialize, observation

LEAST = 100
ORDER = 5
SEGMENT = 1000
BITS = 1 << 26  # of a map of frequent words or pairs
PAIR_BITS = 40
HELD = 1 << 18  # distinct words that a task counts or names before it starts anew
HELD_BYTES = 32 << 20
CHUNK = 1 << 18  # words whose runs are formed at a time

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(0x2E if c in _BREAKS else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

DECIMAL = "decimal(38,0)"


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, with ``.`` between pieces."""
    # what splits bytes beside blanks and tabs (line ends) has become a break
    return (text or b"").translate(_FOLD).replace(b".", b" . ").split()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       docs["text"].cast("binary").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word (binary), n of all words."""
    def run(batches):
        counts: Counter = Counter()
        size = 0

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w, n in Counter(tokens(text)).items():
                    if w != b".":
                        key = (lang, w)
                        if key not in counts:
                            size += len(w)
                        counts[key] += n
                if len(counts) > HELD or size > HELD_BYTES:
                    yield out()
                    counts.clear()
                    size = 0
        yield out()

    return _rows(docs).mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def name_column(seed: int) -> Column:
    """The 64-bit name of a word (columns lang and word); 0 names no word."""
    joined = F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col("word"))
    # Spark's xxhash64 has the fixed seed 42: another seed is put before the text instead
    h = F.xxhash64(joined if not seed else F.concat(F.lit(seed.to_bytes(4, "little")), joined))
    return F.when(h == 0, F.lit(1).cast("long")).otherwise(h)


class Names(dict):
    """Names (``name_column``) of the words of one language, 0 for what no frequent word can be."""

    def __init__(self, lang: str, seed: int, frequent: np.ndarray):
        super().__init__({b".": 0})
        self.prefix = (seed.to_bytes(4, "little") if seed else b"") + lang.encode("utf-8", "surrogatepass") + b"\0"
        self.frequent = frequent
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh64_intdigest(self.prefix + word, 42) or 1
        if not int(self.frequent[(h & (BITS - 1)) >> 6]) >> (h & 63) & 1:
            h = 0
        h -= (1 << 64) if h >> 63 else 0
        if len(self) > HELD or self.size > HELD_BYTES:
            self.clear()
            self[b"."] = 0
            self.size = 0
        self[word] = h
        self.size += len(word)
        return h


def _in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = keys.view(np.uint64) & np.uint64(BITS - 1)
    return (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def bit_map(keys: DataFrame, key: str) -> np.ndarray:
    """A map of BITS bits with those of the keys set; as many rows reach the driver at most."""
    spot = F.col(key).bitwiseAND(F.lit(BITS - 1))
    words = keys.groupBy(F.shiftright(spot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("bits")).collect()
    out = np.zeros(BITS // 64, np.int64)
    if words:
        at, bits = zip(*words, strict=True)
        out[list(at)] = bits
    return out.view(np.uint64)


def _pair_keys(ids: np.ndarray) -> np.ndarray:
    """A key of PAIR_BITS bits of each word with the next (equal pairs have equal keys; others may,
    which makes their counts too large, never too small)."""
    a, b = ids[:-1].view(np.uint64), ids[1:].view(np.uint64)
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - PAIR_BITS)).view(np.int64)


def _sequences(batches, names_of):
    """One array of names a batch and language, 0 between pieces and texts."""
    by_lang: dict[str, Names] = {}
    for b in batches:
        found: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            names = by_lang.get(lang)
            if names is None:
                names = by_lang[lang] = names_of(lang)
            t = tokens(text)
            found.setdefault(lang, [np.zeros(1, np.int64)]).append(
                np.fromiter(map(names.__getitem__, t), np.int64, len(t)))
            found[lang].append(np.zeros(1, np.int64))
        yield from (np.concatenate(x) for x in found.values())
        if sum(len(n) for n in by_lang.values()) > HELD or sum(n.size for n in by_lang.values()) > HELD_BYTES:
            by_lang.clear()


def pair_counts(docs: DataFrame, seed: int, frequent) -> DataFrame:
    """key, n of neighbouring words that the map of frequent words has."""
    def run(batches):
        for ids in _sequences(batches, lambda lang: Names(lang, seed, frequent.value)):
            keys, n = np.unique(_pair_keys(ids)[(ids[:-1] != 0) & (ids[1:] != 0)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    return _rows(docs).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _cut(ids: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The names with a 0 between two words that are no frequent pair."""
    apart = (ids[:-1] != 0) & (ids[1:] != 0) & ~_in_map(pairs, _pair_keys(ids))
    return np.insert(ids, np.flatnonzero(apart) + 1, 0)


def _edges(ids: np.ndarray, order: int) -> np.ndarray:
    """All runs of ``order`` words."""
    if len(ids) < order:
        return np.zeros((0, order), np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(ids, order)
    return runs[(runs != 0).all(1)]


def _ends(ids: np.ndarray, order: int) -> np.ndarray:
    """The last ``order - 1`` words (0 before fewer) of each piece of two words or more."""
    ends = np.flatnonzero((ids[1:-1] != 0) & (ids[:-2] != 0) & (ids[2:] == 0)) + 1
    padded = np.concatenate([np.zeros(order, np.int64), ids])
    tails = np.lib.stride_tricks.sliding_window_view(padded, order - 1)[ends + 2]
    blank = np.logical_or.accumulate((tails == 0)[:, ::-1], 1)[:, ::-1]
    return np.where(blank, 0, tails)


def graph(docs: DataFrame, seed: int, frequent, pairs, order: int) -> DataFrame:
    """w1 .. w``order``, n: the edges; and the piece ends, which have w1 = 0."""
    cols = [f"w{i}" for i in range(1, order + 1)]

    def run(batches):
        for ids in _sequences(batches, lambda lang: Names(lang, seed, frequent.value)):
            ids = _cut(ids, pairs.value)
            ends = np.pad(_ends(ids, order), ((0, 0), (1, 0)))
            for rows in chain([ends], (_edges(ids[k:k + CHUNK + order - 1], order) for k in range(0, len(ids), CHUNK))):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(order)], cols)

    rows = _rows(docs).mapInArrow(run, ", ".join(f"{c} long" for c in cols))
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def compact(edges: DataFrame, order: int) -> DataFrame:
    """path, segment, words (names), n (the weight of the edge that begins at each word): the
    unary paths of a graph given as w1 .. w``order``, n. Each edge is on one path."""
    cols = [f"w{i}" for i in range(1, order + 1)]
    edges = materialize(edges.withColumn("id", F.monotonically_increasing_id()), "heavy-edges")
    nodes = [f"v{i}" for i in range(1, order)]
    out = edges.groupBy(*[F.col(c).alias(v) for c, v in zip(cols[:-1], nodes, strict=True)]).agg(
        F.count(F.lit(1)).alias("n_out"), F.min("id").alias("id")).where("n_out = 1")
    into = edges.groupBy(*[F.col(c).alias(v) for c, v in zip(cols[1:], nodes, strict=True)]).agg(
        F.count(F.lit(1)).alias("n_in"), F.min("id").alias("prev")).where("n_in = 1")
    links = out.join(into, nodes).where("id <> prev").select("id", "prev")
    start = edges.select("id").join(links, "id", "left").select(
        "id", F.coalesce("prev", "id").alias("to"), F.when(F.col("prev").isNull(), 0).otherwise(1).alias("d"),
        F.col("prev").isNull().alias("done"), F.least("id", F.coalesce("prev", "id")).alias("low"))
    while True:
        reach, stable = _doubled(start)
        if stable is None:
            break
        # what is still open lies on cycles: each is opened at its smallest edge
        heads = reach.where("not done and id = low").select("id", F.lit(True).alias("head"))
        start = materialize(start.join(heads, "id", "left").select(
            "id", F.when(F.col("head"), F.col("id")).otherwise(F.col("to")).alias("to"),
            F.when(F.col("head"), 0).otherwise(F.col("d")).alias("d"),
            (F.col("done") | F.coalesce("head", F.lit(False))).alias("done"), "low"), "round")
    placed = edges.join(reach.select("id", F.col("to").alias("path"), F.col("d").cast("long").alias("at")), "id")
    first = F.sort_array(F.collect_list(F.struct("at", *cols, "n")))
    return placed.withColumn("segment", (F.col("at") / SEGMENT).cast("long")).groupBy("path", "segment").agg(
        first.alias("x")).select("path", "segment", F.concat(
            F.transform("x", lambda e: e["w1"]), *[F.array(F.element_at("x", -1)[c]) for c in cols[1:]]).alias("words"),
        F.transform("x", lambda e: e["n"]).alias("n"))


def _doubled(start: DataFrame) -> tuple[DataFrame, bool | None]:
    """Each edge's first edge of its path and the distance, by doubling; the second value is
    None if all are found, else all smallest ids of the cycles left are."""
    def state(obs):
        return (obs, F.count_if(~F.col("done")).alias("open"),
                F.coalesce(F.sum(F.when(~F.col("done"), F.col("low").cast(DECIMAL))), F.lit(0).cast(DECIMAL)).alias("low"))

    reach, now = materialize(start, "round", state(observation("paths")))
    while now["open"]:
        # ``done`` of the edge reached: it is, or reaches, the first of its path
        there = reach.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("d").alias("d2"),
                             F.col("done").alias("done2"), F.col("low").alias("low2"))
        step = reach.join(there, "to").select(
            "id", F.when(F.col("done"), F.col("to")).otherwise(F.col("to2")).alias("to"),
            F.when(F.col("done"), F.col("d")).otherwise(F.col("d") + F.col("d2")).alias("d"),
            (F.col("done") | F.col("done2")).alias("done"), F.least("low", "low2").alias("low"))
        before = now
        reach, now = materialize(step, "round", state(observation("paths")))
        if now == before:
            return reach, True
    return reach, None


def phrase_counts(docs: DataFrame, least: int = LEAST, order: int = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """words (lang, word, n, id: all of them), paths (the compacted heavy edges) and grams
    (g: the names of 2 to ``order`` words, a: their count, at least ``least``)."""
    spark = docs.sparkSession
    seed = 0
    while True:
        words, seen = materialize(word_counts(docs).withColumn("id", name_column(seed)), "words", (
            observation("words"), F.count_if(F.col("n") >= least).alias("frequent")))
        # a frequent word must have its name alone; a name that only rare words share is in no result
        named = small_side(words.where(F.col("n") >= least).select("id"), "frequent-names")
        if words.join(named, "id").count() == seen["frequent"]:
            break
        seed += 1
    frequent = spark.sparkContext.broadcast(bit_map(words.where(F.col("n") >= least), "id"))
    pairs = spark.sparkContext.broadcast(bit_map(
        pair_counts(docs, seed, frequent).where(F.col("n") >= least), "key"))
    cols = [f"w{i}" for i in range(1, order + 1)]
    all_ = materialize(graph(docs, seed, frequent, pairs, order), "edges")
    edges = all_.where("w1 <> 0")
    ends = all_.where("w1 = 0")
    paths = materialize(compact(edges.where(F.col("n") >= least), order), "paths")

    def off_paths(size):
        """Runs of ``size`` words beginning at each edge of the paths."""
        spots = paths.select("words", F.posexplode("n").alias("at", "n"))
        return spots.select(F.slice("words", F.col("at") + 1, size).alias("g"), "n")

    # a node's flow: its edges, those on paths and the light ones, and the pieces that end with it
    size = order - 1
    flow = off_paths(size).unionByName(
        edges.where(F.col("n") < least).select(F.array(*cols[:size]).alias("g"), "n"))
    grams = [off_paths(order).withColumnRenamed("n", "a")]
    while size >= 2:
        last = cols[order - size:]
        flow = flow.unionByName(ends.where(F.col(last[0]) != 0).select(F.array(*last).alias("g"), "n"))
        counted = materialize(flow.groupBy("g").agg(F.sum("n").alias("n")), "flows")
        grams.append(counted.where(F.col("n") >= least).select("g", F.col("n").alias("a")))
        size -= 1
        flow = counted.select(F.slice("g", 1, size).alias("g"), "n")
    out = grams[0]
    for g in grams[1:]:
        out = out.unionByName(g)
    return words, paths, materialize(out, "grams")


def collocations(docs: DataFrame, least: int = LEAST, share: int = 100, top: int = 2000, order: int = ORDER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``order`` words
    that occur ``least`` times. The score is the lowest over the cuts in two, floor(1000 a n / (l r));
    a phrase goes if a longer one holds it with ``share`` hundredths of its count."""
    words, _, grams = phrase_counts(docs, least, order)
    k = F.size("g")
    inner = grams.where(k > 2).select("a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), k - 1), lambda s: F.transform(
            F.sequence(F.lit(1), k - s + 1), lambda i: F.slice("g", i, s))))).alias("g"))
    longer = inner.groupBy("g").agg(F.max("a").alias("longer"))
    left = grams.join(longer, "g", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).select("g", "a")
    parts = grams.unionByName(words.where(F.col("n") >= least).select(F.array("id").alias("g"), F.col("n").alias("a")))
    cuts = left.select("g", "a", F.explode(F.sequence(F.lit(1), k - 1)).alias("k")).select(
        "*", F.slice("g", 1, F.col("k")).alias("first"), F.expr("slice(g, k + 1, size(g))").alias("rest"))
    cuts = cuts.join(parts.select(F.col("g").alias("first"), F.col("a").alias("l")), "first").join(
        parts.select(F.col("g").alias("rest"), F.col("a").alias("r")), "rest")
    totals = small_side(words.groupBy("lang").agg(F.sum("n").alias("n")), "words-of-languages")
    names = words.where(F.col("n") >= least).select("id", "lang", F.col("word").cast("string").alias("word"))
    # one language a phrase: the name of a word has it
    spelt = left.select("g", F.posexplode("g").alias("at", "id")).join(names, "id").groupBy("g").agg(
        F.count(F.lit(1)).alias("known"), F.first("lang").alias("lang"), F.concat_ws(" ", F.transform(
            F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase")).where(F.col("known") == F.size("g")).drop("known")
    scored = cuts.join(spelt, "g").join(totals, "lang").withColumn("score", F.expr(
        "(cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    lowest = scored.groupBy("g").agg(F.min_by(
        F.struct("lang", "phrase", "a", "l", "r", "n", "score"), F.struct("score", "k")).alias("x")).select("x.*")
    rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return lowest.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
