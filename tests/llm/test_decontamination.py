"""Decontamination against an alignment of every document with every item, without seeds."""

import numpy as np
import pytest
from conftest import SMALL_SF

from plexus.llm import decontamination as d
from plexus.llm.common import table

RNG = np.random.default_rng(11)


def _drop(w, keep):
    return [x for i, x in enumerate(w) if keep(i)]


def _swap(w, change):
    return [f"zq{i}" if change(i) else x for i, x in enumerate(w)]


def _add(w, after):
    return [y for i, x in enumerate(w) for y in ([x, f"zq{i}"] if after(i) else [x])]


def _random(share, edit):
    def run(w):
        hit = set(RNG.choice(len(w), round(len(w) * share), replace=False).tolist())
        return edit(w, hit.__contains__)
    return run


EDITS = {
    "whole": lambda w: w,
    "every second word replaced": lambda w: _swap(w, lambda i: i % 2),
    "every third word replaced": lambda w: _swap(w, lambda i: i % 3 == 2),
    "every third word replaced, from the second": lambda w: _swap(w, lambda i: i % 3 == 1),
    "every fourth word replaced": lambda w: _swap(w, lambda i: i % 4 == 3),
    "a quarter replaced": _random(1 / 4, _swap),
    "three tenths replaced": _random(0.3, _swap),
    "every third word dropped": lambda w: _drop(w, lambda i: i % 3 != 2),
    "every fourth word dropped": lambda w: _drop(w, lambda i: i % 4 != 1),
    "a quarter dropped": _random(1 / 4, lambda w, hit: _drop(w, lambda i: not hit(i))),
    "a word after every second": lambda w: _add(w, lambda i: i % 2),
    "a word after each": lambda w: _add(w, lambda i: True),
    "a third added": _random(1 / 3, _add),
    "halves swapped": lambda w: w[len(w) // 2:] + w[:len(w) // 2],
    "first two thirds": lambda w: w[:2 * len(w) // 3],
    "middle": lambda w: w[len(w) // 5:4 * len(w) // 5],
}


@pytest.fixture(scope="module")
def planted(spark):
    """(documents, items, edit of each planted document): every edit of some items amid ordinary text."""
    items = [(r.item_id, r.text) for r in table(spark, SMALL_SF, "benchmark").orderBy("item_id").collect()]
    filler = [r.text for r in table(spark, SMALL_SF, "documents").where("lang = 'en' and length(text) > 300").orderBy("doc_id").limit(60).collect()]
    docs, kind = [(k, f) for k, f in enumerate(filler)], {}
    for e, (name, edit) in enumerate(EDITS.items()):
        for k, (_, text) in enumerate(items[:24]):
            w = text.split()
            if len(w) >= 8:
                f = filler[(7 * e + k) % len(filler)].split()
                i = 1000 + 100 * e + k
                docs.append((i, " ".join(f[:40] + edit(w) + f[40:70])))
                kind[i] = name
    return docs, items, kind


@pytest.fixture(scope="module")
def accepted(planted):
    """Every (document, item) pair whose best alignment reaches the score, by brute force."""
    docs, items, _ = planted
    index = d.build_index(items)
    words = [index.encode(t) for _, t in docs]
    pairs = [(a, i) for a in range(len(docs)) for i in range(len(index.items))]
    scores = d.best_scores([(words[a], index.items[i]) for a, i in pairs])
    return {(docs[a][0], index.item_ids[i]): s / (d.MATCH * len(index.items[i])) for (a, i), s in zip(pairs, scores.tolist(), strict=True)
            if s >= d.LEAST * d.MATCH * len(index.items[i])}


def test_recall_against_all_pairs(spark, planted, accepted):
    docs, items, kind = planted
    got = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r.score for r in got.collect()}
    assert set(found) <= set(accepted) and all(abs(found[p] - accepted[p]) < 1e-9 for p in found)
    per_edit = {}
    for p in accepted:
        per_edit.setdefault(kind.get(p[0], "none"), []).append(p in found)
    shares = {k: sum(v) / len(v) for k, v in per_edit.items()}
    assert {"every third word replaced", "a word after each", "every third word dropped"} <= set(shares)
    assert min(shares.values()) >= 0.9, shares
    assert len(found) >= 0.98 * len(accepted)


def test_seeds_do_not_depend_on_the_size_of_the_corpus(planted):
    """The same corpus a hundred times over keeps the same seeds, and every stretch keeps some."""
    _, items, _ = planted
    index = d.build_index(items)
    counts = np.random.default_rng(3).zipf(1.3, len(index.codes)).clip(max=10 ** 6)
    for times in (1, 100):
        kept = d.rare_only(index, counts * times, 3_000_000 * times)
        if times == 1:
            want = kept
    assert len(want.codes) < len(index.codes)
    assert set(want.codes.tolist()) <= set(kept.codes.tolist()) or len(kept.codes) >= 0.99 * len(want.codes)
    for k, w in enumerate(index.items):
        for part in range(0, len(w) - max(b for _, b in d.SHAPES), d.STRETCH):
            assert (want.place[want.item == k] // d.STRETCH == part // d.STRETCH).sum() >= min(d.KEEP, 4)


def test_common_passages_keep_their_seeds(planted):
    """An item copied thousands of times: all its seeds are frequent, none is left out."""
    index = d.build_index(planted[1][:1])
    assert len(d.rare_only(index, np.full(len(index.codes), 5000), 100_000).codes) == len(index.codes)


def test_long_texts_are_cut_into_bounded_windows(planted):
    _, items, _ = planted
    index = d.build_index(items[:1])
    w = index.encode(" ".join([items[0][1]] * 400))
    found = d.windows(index, [w])
    assert max(b - a for *_, a, b in found) <= 8 * len(index.items[0]) + 8
    assert max(b for *_, b in found) == len(w) and len(found) > 20
    assert d.find(index, [" ".join([items[0][1]] * 400)], d.LEAST)[0][2] == 1.0


def test_equal_and_missing_item_ids(spark, planted, monkeypatch):
    """Items without an id or with one id are dealt to blocks by their texts too."""
    docs, items, _ = planted
    df = spark.createDataFrame(docs[-40:], "doc_id long, text string")
    want = sorted((r.doc_id, round(r.score, 9)) for r in d.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect())
    monkeypatch.setattr(d, "BLOCK_WORDS", 2000)
    for same in (None, 5):
        got = d.contaminated(df, spark.createDataFrame([(same, t) for _, t in items], "item_id long, text string")).collect()
        assert want and sorted((r.doc_id, round(r.score, 9)) for r in got) == want
