"""A linear-chain conditional random field over words, in numpy.

Each word's features are hashed into a weight table (one weight a label); label to
label transitions are learned. Scores of a distinct word are worked out once and
cached; forward-backward runs over many sequences at once, one word of each a step.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

BREAKS = (".", "!", "?", "\n")  # a sequence is what stands between two of them
CACHE_WORDS = 300_000


class Words(dict):
    """word -> number; the first numbers are the breaks, new words wait in ``new``."""

    def __init__(self):
        super().__init__((b, i) for i, b in enumerate(BREAKS))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


@dataclass
class Sequences:
    """Words of some texts in a row. ``text``: of each word; starts and lengths of sequences."""

    words: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def read(texts: list[str], pattern: re.Pattern, index: Words) -> Sequences:
    parts = []
    for t in texts:
        toks = pattern.findall(t)
        toks.append("\n")
        parts.append(np.fromiter(map(index.__getitem__, toks), np.int64, len(toks)))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    word = flat >= len(BREAKS)
    run = np.cumsum(~word)[word]
    words, text = flat[word], text[word]
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    return Sequences(words, text, starts, np.diff(np.concatenate([starts, [len(words)]])))


_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd mixing constants


@dataclass
class Features:
    """Hashed features of words, in small letters: the word, its first and last letters,
    letter n-grams with its borders, its length, and the label its lexicon gives it."""

    prefixes: tuple[int, ...] = ()
    suffixes: tuple[int, ...] = ()
    grams: tuple[int, ...] = ()
    lengths: bool = False
    lexicon: dict[str, int] = field(default_factory=dict)
    bits: int = 18

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all words in a row, and the word that each belongs to."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = [w.lower() for w in words]
        sizes = np.array([len(w) + 2 for w in low])  # with a border on either side
        joined = "\x02" + "\x03\x02".join(low) + "\x03"
        a = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.cumsum(sizes) - sizes
        every, owner = np.arange(len(words)), np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(a)) - starts[owner]
        longest = max(int(sizes.max()), *self.prefixes, *self.suffixes, *self.grams, 1)
        powers = np.cumprod(np.full(longest, _K1))
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def add(family: int, h: np.ndarray, of: np.ndarray) -> None:
            h = (h ^ np.uint64(family * 0x632BE5AB + 1)) * _K2
            h = (h ^ (h >> np.uint64(29))) * _K1
            out.append(((h >> np.uint64(64 - self.bits)).astype(np.int64), of))

        def run(at: np.ndarray, n: int) -> np.ndarray:
            return sum(a[at + j] * powers[j] for j in range(n))

        add(1, np.add.reduceat(a * powers[place], starts), every)
        for n in self.prefixes:
            of = every[sizes >= n + 2]
            add(10 + n, run(starts[of] + 1, n), of)
        for n in self.suffixes:
            of = every[sizes >= n + 2]
            add(30 + n, run(starts[of] + sizes[of] - 1 - n, n), of)
        for n in self.grams:
            at = np.flatnonzero(place + n <= sizes[owner])
            add(50 + n, run(at, n), owner[at])
        if self.lengths:
            add(2, np.minimum(sizes, 14).astype(np.uint64), every)
        if self.lexicon:
            known = [(i, k) for i, k in enumerate(map(self.lexicon.get, low)) if k is not None]
            if known:
                of, label = np.array(known).T
                add(3, label.astype(np.uint64), of)
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


@dataclass
class CRF:
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # from x to

    def scores(self, words: list[str], features: Features) -> np.ndarray:
        """Label scores of distinct words."""
        at, owner = features(words)
        return np.stack([np.bincount(owner, w[at], len(words)) for w in self.weights.T], 1).astype(np.float32)

    def marginals(self, scores: np.ndarray, seq: Sequences, pairs: np.ndarray | None = None) -> np.ndarray:
        """Probability of each label of each word. ``pairs`` collects expected transitions."""
        n, k = scores.shape
        emit = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
        move = np.exp(self.transitions - self.transitions.max()).astype(np.float32)
        order = np.argsort(-seq.lengths, kind="stable")
        starts, lengths = seq.starts[order], seq.lengths[order]
        longest = int(lengths[0]) if len(lengths) else 0
        counts = np.searchsorted(-lengths, -np.arange(longest), "left")  # sequences longer than t
        alpha = np.empty((n, k), np.float32)
        a = None
        for t in range(longest):
            at = starts[:counts[t]] + t
            a = emit[at] if a is None else (a[:counts[t]] @ move) * emit[at]
            a /= a.sum(1, keepdims=True)
            alpha[at] = a
        out = np.empty((n, k), np.float32)
        b = np.ones((0, k), np.float32)
        for t in range(longest - 1, -1, -1):
            c = counts[t]
            at = starts[:c] + t
            if len(b):  # sequences that go on
                m = len(b)
                b = (b * emit[at[:m] + 1])
                if pairs is not None:
                    joint = alpha[at[:m]][:, :, None] * move * b[:, None, :]
                    pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                b = b @ move.T
            b = np.concatenate([b, np.ones((c - len(b), k), np.float32)])
            b /= b.sum(1, keepdims=True)
            p = alpha[at] * b
            out[at] = p / p.sum(1, keepdims=True)
        return out


def train(words: list[str], seq: Sequences, labels: np.ndarray, n_labels: int, features: Features,
          rounds: int = 40, rate: float = 0.15, decay: float = 1e-6) -> CRF:
    """Maximum likelihood by Adam over all sequences. ``words``: of each word number from
    len(BREAKS); ``labels``: of each word in ``seq``."""
    feat, owner = features(words)
    used, feat = np.unique(feat, return_inverse=True)
    at = seq.words - len(BREAKS)
    n = max(1, len(at))
    w, tr = np.zeros((len(used), n_labels)), np.zeros((n_labels, n_labels))
    gold = np.zeros((len(words), n_labels))
    np.add.at(gold, (at, labels), 1.0)
    inside = np.ones(len(at), bool)
    inside[seq.starts] = False
    follow = np.flatnonzero(inside)
    gold_pairs = np.zeros((n_labels, n_labels))
    np.add.at(gold_pairs, (labels[follow - 1], labels[follow]), 1.0)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, tr)]
    for step in range(1, rounds + 1):
        per_word = np.stack([np.bincount(owner, w[feat, k], len(words)) for k in range(n_labels)], 1)
        model = CRF(w, tr)
        pairs = np.zeros((n_labels, n_labels))
        m = model.marginals(per_word[at].astype(np.float32), seq, pairs)
        expected = np.stack([np.bincount(at, m[:, k], len(words)) for k in range(n_labels)], 1)
        slope = expected - gold
        grads = (np.stack([np.bincount(feat, slope[owner, k], len(used)) for k in range(n_labels)], 1) / n + decay * w,
                 (pairs - gold_pairs) / n + decay * tr)
        for x, g, s in zip((w, tr), grads, state, strict=True):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            x -= rate * (s[0] / (1 - 0.9 ** step)) / (np.sqrt(s[1] / (1 - 0.99 ** step)) + 1e-8)
    full = np.zeros((1 << features.bits, n_labels), np.float32)
    full[used] = w
    return CRF(full, tr.astype(np.float32))


class Tagger:
    """A trained model in a Python worker, with its cache of word scores."""

    def __init__(self, model: CRF, pattern: re.Pattern, features: Features):
        self.model, self.pattern, self.features = model, pattern, features
        self.reset()

    def reset(self) -> None:
        self.index = Words()
        self.scores = np.zeros((1 << 14, self.model.weights.shape[1]), np.float32)

    def tag(self, texts: list[str]) -> tuple[Sequences, np.ndarray]:
        if len(self.index) > CACHE_WORDS:
            self.reset()
        seq = read(texts, self.pattern, self.index)
        new, self.index.new = self.index.new, []
        while len(self.index) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        if new:
            self.scores[len(self.index) - len(new):len(self.index)] = self.model.scores(new, self.features)
        return seq, self.model.marginals(self.scores[seq.words], seq)
