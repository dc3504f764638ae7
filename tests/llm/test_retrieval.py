"""Nearest neighbours, collocations and ranked search against brute force, and on odd input."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL_SF
from pyspark.sql import functions as F

from plexus.llm import collocations, ranked_search, rp_forest
from plexus.llm.common import table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, n long, term string, w1 string, `a.b` string, score string"
ITEMS = "item_id long, text string, doc_id string, score string, n string"


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# nearest neighbours

def nearest_by_hand(rows, k, is_query):
    """rows: (id, vector), different ids."""
    out = []
    for q, v in rows:
        if is_query(q):
            s = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows if i != q)
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out, key=str)


def test_nearest_recall(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "LEAF", 16)
    e = table(spark, SMALL_SF, "embeddings")
    found = rp_forest.nearest(e, lambda i: i % 5 == 0, k=10).cache()
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    truth = spark.createDataFrame(nearest_by_hand(rows, 10, lambda i: i % 5 == 0), "query_id long, rank int, vec_id long, score double")
    assert rp_forest.recall(found, truth) >= 0.9
    at = dict(rows)
    for q, r, v, s in rows_of(found, "query_id", "rank", "vec_id", "score"):
        assert q != v and 1 <= r <= 10 and abs(s - np.dot(at[q], at[v])) < 1e-9
    assert found.groupBy("query_id").count().where("count <> 10").count() == 0


def test_nearest_exact_with_all_leaves(spark, monkeypatch):
    """A third of the rows are one vector, norms differ, and leaves are cut into chunks and copies."""
    for name, value in (("LEAF", 8), ("CHUNK", 4), ("VISITS", 10)):
        monkeypatch.setattr(rp_forest, name, value)
    monkeypatch.setattr(rp_forest, "calibrate", lambda f, *a: len(f.splits) * 2 ** f.depth)
    rng = random.Random(3)
    rows = [(i, [1.0, 2.0, -1.0]) if i % 3 == 0 else (i, [float(rng.randint(-9, 9)) or 1.0 for _ in range(3)]) for i in range(240)]
    got = rp_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 4 == 0, k=7)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == nearest_by_hand(rows, 7, lambda i: i % 4 == 0)


def test_priority_queue_takes_the_nearest_leaves():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 6))
    f = rp_forest.fit(x, float((x ** 2).sum(1).max()), len(x), trees=3, leaf=25)
    p = f.projected(x[:9], True)
    for k in range(9):
        cost = {}
        for t in range(3):
            for leaf in range(2 ** f.depth):
                node, c = leaf + 2 ** f.depth - 1, 0.0
                for level in reversed(range(f.depth)):
                    up = (node - 1) // 2
                    m = p[t, level, k] - f.splits[t, up]
                    c += m * m if (node == 2 * up + 2) != (m >= 0) else 0.0
                    node = up
                cost[t, leaf] = c
        order = f.visits(p[:, :, k], 20)
        assert len(set(order)) == 20
        assert np.allclose([cost[x] for x in order], sorted(cost.values())[:20])


def test_nearest_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "a"), (20, [1.0, 0.0], "b"), (40, [0.0, 0.0], "c"), (60, None, "d"), (80, [], "e"), (None, [1.0, 1.0], "f"),
            (100, [nan, 1.0], "g"), (120, [inf, 1.0], "h"), (140, [None, 1.0], "i"), (1, [2.0, -1.0], "j"), (2, [1.0, 2.0, 3.0], "k"),
            (20, [1.0, 0.0], "l"), (1, [3.0, 1.0], "m"), (3, [-1.0, 0.5], "n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, query string, `a.b` string")
    got = rows_of(rp_forest.nearest(df, lambda i: i % 20 == 0), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 2.0), (0, 2, 20, 1.0), (0, 3, 3, -1.0), (20, 1, 1, 2.0), (20, 2, 0, 1.0), (20, 3, 3, -1.0)]
    assert rp_forest.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0
    assert rp_forest.nearest(df.where("vec_id = 1"), lambda i: i % 20 == 0).count() == 0


# collocations

def collocations_by_hand(docs, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = [g for g, a in c.items() if len(g) > 1 and a >= least]
        longest = Counter()
        for g in cand:
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longest[g[i:i + k]] = max(longest[g[i:i + k]], c[g])
        rows = []
        for g in cand:
            if g not in longest or 100 * longest[g] < share * c[g]:
                s, _, l, r = min((1000 * c[g] * n[lang] // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
                rows.append((-s, -c[g], " ".join(g).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out, key=str)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(("least", "share", "top"), [(3, 100, 2000), (5, 60, 7)])
def test_collocations(spark, least, share, top):
    """Random words, a passage of 80 words in many texts (a long unary path), cycles, a third of the rows one text."""
    rng = random.Random(least)
    words = ["Ab", "b", "c", "dé", "e", "F", "g-1", "(h)"]
    passage = " ".join(f"p{i}" for i in range(80))
    docs = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", ", ", "\n", "  "]) for _ in range(rng.randint(0, 40)))
        docs.append((text + passage[: rng.randint(0, 300)] if i % 3 else text, rng.choice(["en", "de", None])))
    docs += [("a ring of words a ring of words a ring of words a ring of words", "en")] * 75
    docs += [("x x x x x x x x x x", "fr")] * 3 + [(None, "en"), ("", None), (" \t\n.;", "und")]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string")
    got = collocations.collocations(df, least, share, top)
    assert rows_of(got, *COLUMNS) == collocations_by_hand(docs, least, share, top)


def test_compact_paths(spark):
    """Every edge is on one path, paths run on wherever only one edge goes in and out, cycles end."""
    chain = [(i, i + 1) for i in range(1, 30)]
    cycle = [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
    fork = [(30, 40), (30, 50), (40, 41), (50, 60), (41, 60), (60, 61), (200, 200)]
    edges = [(*e, 10 + i) for i, e in enumerate(chain + cycle + fork)]
    got = collocations.compact(spark.createDataFrame(edges, "w1 long, w2 long, n long"), 2).collect()
    read = sorted((a, b, n) for r in got for a, b, n in zip(r.words, r.words[1:], r.n, strict=False))
    assert read == sorted(edges)
    assert sorted(len(r.n) for r in got) == sorted([29, 7, 3, 2, 1, 1])


def test_collocations_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 5)
    monkeypatch.setattr(collocations, "CHUNK", 8)
    long = "one two three four five six seven eight nine ten " * 400
    docs = [(1, long, "en"), (2, long.upper(), "en"), (2, long.upper(), "en"), (3, "w" * 100_000 + " x", None), (None, "x y z x y z", "und")]
    df = spark.createDataFrame([(*d, 1, "t", "w", "ab", "s") for d in docs], DOCS)
    assert rows_of(collocations.collocations(df, 2), *COLUMNS) == collocations_by_hand([d[1:] for d in docs], 2, 100, 2000)
    assert collocations.collocations(df.limit(0)).count() == 0
    assert collocations.collocations(df.where("doc_id = 3")).count() == 0


# ranked search

def search_by_hand(docs, items, k):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    read = [(i, Counter(pattern.findall((t or "").translate(LOW)))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in read if c), sum(sum(c.values()) for _, c in read)
    df = Counter(t for _, c in read for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in read:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(pattern.findall((text or "").translate(LOW))) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def test_ranked_search(spark, monkeypatch):
    """Many shards a task, a third of the documents one text, more hits than the k best keep."""
    monkeypatch.setattr(ranked_search, "SHARD", 64)
    monkeypatch.setattr(ranked_search, "BATCH", 4)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "naïve", "日本", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60))) if i % 3 else "w1 w2, w3; w50 A1") for i in range(900)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(30)] + [(99, "nothing here"), (98, "w1 W50 w50")]
    got = ranked_search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                      spark.createDataFrame(items, "item_id long, text string"), k=6)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == search_by_hand(docs, items, 6)


def test_ranked_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 2000)
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL_SF, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SMALL_SF, "benchmark").collect()]
    got = ranked_search.ranked_search(table(spark, SMALL_SF, "documents"), table(spark, SMALL_SF, "benchmark"))
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == search_by_hand(docs, items, 10)


def test_range_maxima():
    rng = np.random.default_rng(2)
    docs = 300
    at = rng.choice(4 * docs, 500, replace=False)
    term, doc, impact = at // docs, at % docs, rng.integers(1, 50, 500)
    p = ranked_search.Postings(term, doc, impact, docs)
    lo = rng.integers(0, docs, 200)
    hi = lo + rng.integers(1, docs, 200).clip(max=docs - lo)
    value, where = p.maxima(np.arange(4), lo, hi)
    for i in range(200):
        for t in range(4):
            inside = (term == t) & (doc >= lo[i]) & (doc < hi[i])
            assert value[i, t] == (impact[inside].max() if inside.any() else 0)
            assert not inside.any() or (p.impact[where[i, t]] == value[i, t] and lo[i] <= p.doc[where[i, t]] < hi[i])


def test_ranked_search_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .;\n"), (4, "Word word WORD \x00 end"), (5, "word " * 50_000 + "rare"), (None, "rare word"),
            (None, "rare word"), (7, "rare word"), (7, "rare word"), (8, "Äpfel ärger")]
    items = [(1, "rare WORD"), (1, "rare WORD"), (2, None), (3, ""), (None, "end"), (4, "äpfel"), (1, "Äpfel")]
    d = spark.createDataFrame([(*x, "en", 1, "t", "w", "ab", "s") for x in docs], DOCS.replace("lang string, n long", "lang string, n long"))
    i = spark.createDataFrame([(*x, "d", "s", "n") for x in items], ITEMS)
    assert rows_of(ranked_search.ranked_search(d, i), "item_id", "rank", "doc_id", "score") == search_by_hand(docs, items, 10)
    assert ranked_search.ranked_search(d.limit(0), i).count() == 0
    assert ranked_search.ranked_search(d, i.limit(0)).count() == 0
    assert ranked_search.ranked_search(d.where(F.col("text").isNull()), i).count() == 0
