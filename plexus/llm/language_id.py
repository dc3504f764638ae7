"""Language identification by a linear-chain CRF over words.

Features of a word are itself, affixes of 1 to 4 letters, letter 2- and 3-grams with
the word's borders, and the languages whose lexicon has it. Transitions between
labels are learned from the sample's sentences, of which JOINED of a hundred are put
behind a sentence of another document, so switches within a line are seen.
Forward-backward labels every word; a document's language is the one with the
highest mean marginal over its words.

The fit uses a bounded sample: SAMPLE documents of each language (the smallest hashes, short
texts first; of longer ones the first SAMPLE_CHARS characters teach), fewer if there are more than
MAX_SAMPLE / SAMPLE languages, but one of each at least. Lexicon: words seen LEXICON_COUNT times in the
sample, nine of ten times in one language. Scoring is one narrow pass over whole
texts; the model has a fixed size and is broadcast.

Edge cases: null texts and texts without a letter are ``und`` with score 0; ties go
to the first language by name; repeated rows are judged one by one; null languages
teach nothing; without any labelled text everything is ``und``; an empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.ranking import top_k_per_group
from plexus.llm import crf
from plexus.llm.common import crc_mod, small_side

SAMPLE = 200
MAX_SAMPLE = 20_000
SAMPLE_CHARS = 20_000
JOINED = 30
LEXICON_COUNT = 20
PATTERN = re.compile(r"[^\W\d_]+|[.!?\n]")
TASK_CHARS = 1 << 21


def features_of(lexicon: dict[str, int]) -> crf.Features:
    return crf.Features(prefixes=(1, 2, 3, 4), suffixes=(1, 2, 3, 4), grams=(2, 3), lexicon=lexicon)


@dataclass
class Model:
    languages: list[str]
    chain: crf.CRF | None
    features: crf.Features


def _lexicon(words: list[str], counts: np.ndarray) -> dict[str, int]:
    """Frequent words of one language, with its number; ``counts``: word x language."""
    small: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(counts.shape[1]))
    for w, c in zip(words, counts, strict=True):
        small[w.lower()] += c
    return {w: int(c.argmax()) for w, c in small.items()
            if c.sum() >= LEXICON_COUNT and c.max() >= 0.9 * c.sum()}


def fit(texts: list[str], langs: list[str], rounds: int = 30) -> Model:
    languages = sorted(set(langs))
    if not languages:
        return Model([], None, features_of({}))
    number = {x: i for i, x in enumerate(languages)}
    index = crf.Words()
    seq = crf.read(texts, PATTERN, index)
    words = index.new
    label = np.array([number[x] for x in langs])[seq.text]
    counts = np.zeros((len(words), len(languages)))
    np.add.at(counts, (seq.words - len(crf.BREAKS), label), 1)
    feats = features_of(_lexicon(words, counts))
    # sentences in a mixed order, some of them run together
    rng = np.random.default_rng(7)
    order = rng.permutation(len(seq.starts))
    starts, lengths = seq.starts[order], seq.lengths[order]
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
    apart = rng.integers(0, 100, len(order)) >= JOINED
    apart[:1] = True
    first = (ends - lengths)[apart]
    mixed = crf.Sequences(seq.words[at], seq.text[at], first, np.diff(np.concatenate([first, [len(at)]])))
    chain = crf.train(words, mixed, label[at], len(languages), feats, rounds=rounds)
    return Model(languages, chain, feats)


def train(docs: DataFrame, learn) -> Model:
    """Fit on documents whose language is known; ``learn``: a condition on doc_id."""
    known = docs.where(docs["lang"].isNotNull() & learn(docs["doc_id"]) & docs["text"].isNotNull()).select(
        docs["lang"].cast("string").alias("lang"), docs["doc_id"], docs["text"], F.xxhash64(docs["text"]).alias("h"))
    languages = known.select("lang").distinct().count()
    each = max(1, min(SAMPLE, MAX_SAMPLE // max(1, languages)))
    order = [F.length("text") > SAMPLE_CHARS, F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    keys = known.select("lang", "doc_id", "h", *[c.alias(f"o{i}") for i, c in enumerate(order)])
    picked = top_k_per_group(keys, "lang", [F.col(f"o{i}") for i in range(len(order))], each).select("lang", "doc_id", "h").distinct()
    rows = (known.join(small_side(picked, "language-sample"), ["lang", "doc_id", "h"], "left_semi").dropDuplicates(["lang", "doc_id", "h"])
            .orderBy("lang", F.xxhash64("doc_id"), "doc_id", "h")
            .select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect())
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


_TAGGERS: dict[str, crf.Tagger] = {}  # of this Python worker, by the name of a scoring job


def label(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, spans (runs of words of one language: start, end, lang) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid4().hex
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        m: Model = shared.value
        if m.chain and key not in _TAGGERS:
            _TAGGERS.clear()
            _TAGGERS[key] = crf.Tagger(m.chain, PATTERN, m.features)

        def tag(ids, texts):
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            found: list[list] = [[] for _ in texts]
            if m.chain:
                seq, marg = _TAGGERS[key].tag(texts)
                bounds = np.searchsorted(seq.text, np.arange(len(texts) + 1))
                total = np.zeros((len(texts), len(m.languages)))
                for k in range(len(m.languages)):
                    total[:, k] = np.bincount(seq.text, marg[:, k], len(texts))
                n = np.diff(bounds)
                best = total.argmax(1)
                for t in np.flatnonzero(n).tolist():
                    langs[t] = m.languages[best[t]]
                    scores[t] = min(1.0, total[t, best[t]] / n[t])
                    if spans:
                        found[t] = runs(texts[t], marg[bounds[t]:bounds[t + 1]].argmax(1), m.languages)
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()), "spans": pa.array(found, span)})

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                # the pattern also takes signs like one half, which alone make no word
                texts.append(t if t and any(map(str.isalpha, t)) else "")
                size += len(texts[-1])
                if size >= TASK_CHARS:
                    yield tag(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield tag(ids, texts)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>")


def runs(text: str, labels: np.ndarray, languages: list[str]) -> list[dict]:
    out: list[dict] = []
    at = [x.span() for x in PATTERN.finditer(text) if x[0] not in crf.BREAKS]
    for (a, b), k in zip(at, labels.tolist(), strict=True):
        if out and out[-1]["lang"] == languages[k]:
            out[-1]["end"] = b
        else:
            out.append({"start": a, "end": b, "lang": languages[k]})
    return out


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(crc_mod(doc_id, folds) == fold, F.lit(False))
