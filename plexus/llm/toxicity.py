"""Toxicity: a linear-chain CRF tags toxic words, its marginals score documents.

Labels are given per document, the CRF needs them per word. In a document labelled
toxic, a word counts as toxic if the word or one of its prefixes is found in
toxic documents significantly more often than in others (likelihood-ratio statistic
above EVIDENCE and RATIO times as often, copies of one document and a passage that
toxic documents share counted once); all other words, and all words of other
documents, are clean. Forward-backward gives each word its marginal. The document
score is a logistic function of the highest marginal and of the expected number of
toxic words, fitted to the document labels at their true rate; offending spans are
the runs of words with a marginal of one half or more.

The fit uses a bounded sample: SAMPLE documents of each class (the smallest hashes of
their doc_id), none longer than SAMPLE_CHARS. Scoring is one narrow pass over whole
texts; the model has a fixed size and is broadcast.

Edge cases: null, empty and blank texts have no words and get the score of a text
without evidence; repeated rows are scored one by one; repeated labels of a document
count once, with the highest value; null labels and doc_ids teach nothing; without
labels of both classes every score is the rate of toxic labels (0 if none); an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import crf
from plexus.llm.common import crc_mod

SAMPLE = 1000
SAMPLE_CHARS = 20_000
EVIDENCE = 20.0
RATIO = 10.0
PREDICT = 0.3
SKETCH = 256
PATTERN = re.compile(r"\w+|[.!?\n]")
TASK_CHARS = 1 << 21


FEATURES = crf.Features(prefixes=(3, 4, 5), suffixes=(3, 4), lengths=True)


def marks(word: str) -> list[str]:
    """What is counted to find toxic words."""
    w = word.lower()
    return ["w" + w, *[f"p{k}{w[:k]}" for k in (3, 4, 5) if len(w) > k]]


def copy_groups(texts: list[str]) -> list[int]:
    """A group number for each text of the sample: texts with most of their shingles in
    common are copies of one another; a shared passage in different texts makes none."""
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sets, first = [], {}  # equal sets of shingles are one
    for i, t in enumerate(texts):
        w = t.split()
        hashes = frozenset(crc32(" ".join(w[k:k + 5]).encode("utf-8", "surrogatepass")) for k in range(max(1, len(w) - 4)))
        sets.append(hashes)
        parent[i] = first.setdefault(hashes, i)
    each = list(first.values())
    sketches = [sorted(sets[i])[:SKETCH] for i in each]
    holders: dict[int, list[int]] = {}
    for i, sketch in zip(each, sketches, strict=True):
        seen = [np.array(holders[h]) for h in sketch if h in holders]
        if seen:
            near, common = np.unique(np.concatenate(seen), return_counts=True)
            for j, c in zip(near.tolist(), common.tolist(), strict=True):
                # so many at least of the smallest hashes are common where most of all are
                if 8 * c >= 3 * min(len(sketch), len(sets[j])) and root(i) != root(j):
                    both = len(sets[i] & sets[j])
                    if 2 * both > len(sets[i]) + len(sets[j]) - both:
                        a, b = root(i), root(j)
                        parent[max(a, b)] = min(a, b)
        for h in sketch:
            holders.setdefault(h, []).append(i)
    return [root(i) for i in range(len(texts))]


def novel(seq: crf.Sequences, toxic: list[int], groups: list[int]) -> np.ndarray:
    """Whether each word is evidence: in a toxic text only the first group of texts that has
    the word between the same two words before and after it; elsewhere all."""
    n = len(seq.words)
    if not n:
        return np.zeros(0, bool)
    wide = np.concatenate([[-1, -1], seq.words, [-1, -1]])
    text = np.concatenate([[-1, -1], seq.text, [-1, -1]])
    around = np.stack([np.where(text[k:k + n] == seq.text, wide[k:k + n], -1) for k in range(5)], 1)
    group = np.array(groups)[seq.text]
    hot = np.flatnonzero(np.array(toxic, bool)[seq.text])
    out = np.ones(n, bool)
    if len(hot):
        order = hot[np.lexsort((group[hot], *around[hot].T))]
        start = np.concatenate([[True], (around[order[1:]] != around[order[:-1]]).any(1)])
        lead = group[order][start][np.cumsum(start) - 1]
        out[order] = group[order] == lead
    return out


def _toxic_marks(words: list[set[str]], toxic: list[int], groups: list[int]) -> set[str]:
    """Marks that toxic documents have significantly more often; a group of copies counts once."""
    sides: list[dict[int, set[str]]] = [{}, {}]
    for ws, y, g in zip(words, toxic, groups, strict=True):
        sides[y].setdefault(g, set()).update(m for w in ws for m in marks(w))
    cold, hot = (Counter(m for ms in side.values() for m in ms) for side in sides)
    n0, n1 = (max(1, len(side)) for side in sides)
    found = set()
    for m, a in hot.items():
        b = cold[m]
        expect = (a + b) * n1 / (n1 + n0)
        g = 2 * (a * np.log(a / expect) + (b * np.log(b / (a + b - expect)) if b else 0.0))
        if a / n1 > RATIO * b / n0 and g > EVIDENCE:
            found.add(m)
    return found


def found_marks(texts: list[str], toxic: list[int], seq: crf.Sequences, words: list[str]) -> set[str]:
    """The toxic marks of the sample, neither copies nor shared passages taken for evidence."""
    bounds = np.searchsorted(seq.text, np.arange(len(texts) + 1))
    groups = copy_groups(texts)
    counts = novel(seq, toxic, groups)
    per_text = [{words[i - len(crf.BREAKS)] for i in set(seq.words[a:b][counts[a:b]].tolist())}
                for a, b in zip(bounds, bounds[1:], strict=False)]
    return _toxic_marks(per_text, toxic, groups)


@dataclass
class Model:
    chain: crf.CRF | None
    logistic: np.ndarray  # intercept, weight of the highest marginal's logit, weight of log1p(expected count)
    rate: float


def evidence(seq: crf.Sequences, toxic: np.ndarray, n_texts: int) -> np.ndarray:
    """Rows (1, logit of the highest marginal, log1p of the expected number) of texts."""
    top, total = np.zeros(n_texts), np.zeros(n_texts)
    np.maximum.at(top, seq.text, toxic)
    np.add.at(total, seq.text, np.where(toxic > 0.01, toxic, 0.0))
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(n_texts), np.log(top / (1 - top)), np.log1p(total)], 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * w)
    return w


def fit(texts: list[str], toxic: list[int], rate: float) -> Model:
    """A model from whole texts with their document labels."""
    if not any(toxic) or all(toxic):
        return Model(None, np.zeros(3), rate)
    index = crf.Words()
    seq = crf.read(texts, PATTERN, index)
    words = index.new
    bad = found_marks(texts, toxic, seq, words)
    is_bad = np.array([any(m in bad for m in marks(w)) for w in words], bool)
    y = np.array(toxic, bool)
    labels = (is_bad[seq.words - len(crf.BREAKS)] & y[seq.text]).astype(np.int64) if len(seq.words) else np.zeros(0, np.int64)
    chain = crf.train(words, seq, labels, 2, FEATURES)
    tagger = crf.Tagger(chain, PATTERN, FEATURES)
    rows = []
    for k in range(0, len(texts), 200):
        s, m = tagger.tag(texts[k:k + 200])
        rows.append(evidence(s, m[:, 1], len(texts[k:k + 200])))
    share = y.mean()
    weight = np.where(y, rate / share, (1 - rate) / (1 - share))
    return Model(chain, _logistic(np.concatenate(rows), y.astype(float), weight), rate)


def train(docs: DataFrame, labels: DataFrame, learn=None) -> Model:
    """Fit on labelled documents; ``learn``: a condition on doc_id for rows that may teach."""
    lab = labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull())
    if learn is not None:
        lab = lab.where(learn(F.col("doc_id")))
    lab = lab.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in lab.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    total = sum(counts.values())
    rate = counts.get(True, 0) / total if total else 0.0
    # twice the sample, as some documents are missing or too long
    ids = [lab.where((F.col("toxic") == 1) == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE) for y in (True, False)]
    ids = ids[0].union(ids[1])
    rows = (docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
            .join(F.broadcast(ids), "doc_id"))  # at most 4 * SAMPLE short rows
    picked = []
    for y in (True, False):
        picked += (rows.where((F.col("toxic") == 1) == y).orderBy(F.xxhash64("doc_id"), "doc_id", "text")
                   .limit(SAMPLE).select("text").collect())
        if y:
            n_toxic = len(picked)
    toxic = [1] * n_toxic + [0] * (len(picked) - n_toxic)
    return fit([r["text"] for r in picked], toxic, rate)


_TAGGERS: dict[str, crf.Tagger] = {}  # of this Python worker, by the name of a scoring job


def score(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """doc_id, score (0 to 1), spans (start, end in characters, highest marginal) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid4().hex
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        m: Model = shared.value
        if m.chain and key not in _TAGGERS:
            _TAGGERS.clear()
            _TAGGERS[key] = crf.Tagger(m.chain, PATTERN, FEATURES)

        def tag(ids, texts):
            found: list[list] = [[] for _ in texts]
            if m.chain:
                seq, marg = _TAGGERS[key].tag(texts)
                p = marg[:, 1].astype(float)
                s = 1 / (1 + np.exp(-evidence(seq, p, len(texts)) @ m.logistic))
                if spans and len(p):
                    bounds = np.searchsorted(seq.text, np.arange(len(texts) + 1))
                    for t in np.unique(seq.text[p >= 0.5]).tolist():
                        found[t] = runs(texts[t], p[bounds[t]:bounds[t + 1]])
            else:
                s = np.full(len(texts), m.rate)
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "score": pa.array(s, pa.float64()), "spans": pa.array(found, span)})

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1])
                if size >= TASK_CHARS:
                    yield tag(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield tag(ids, texts)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start: long, end: long, score: double>>")


def runs(text: str, p: np.ndarray) -> list[dict]:
    """Runs of words with a marginal of at least one half."""
    at = [x.span() for x in PATTERN.finditer(text) if x[0] not in crf.BREAKS]
    out: list[dict] = []
    last = -2
    for i in np.flatnonzero(p >= 0.5).tolist():
        if i == last + 1:
            out[-1]["end"], out[-1]["score"] = at[i][1], max(out[-1]["score"], float(p[i]))
        else:
            out.append({"start": at[i][0], "end": at[i][1], "score": float(p[i])})
        last = i
    return out


def held_out(doc_id, folds: int = 4, fold: int = 2):
    return F.coalesce(crc_mod(doc_id, folds) == fold, F.lit(False))
