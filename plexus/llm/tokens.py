"""Token ids by a public tokenizer file, cached by word.

The tokenizer of ``word_bpe_49k.json`` drops white space and never merges across
it, so the ids of a text are the ids of its words one after the other. Every
distinct word goes to the ``tokenizers`` library once per cache generation; texts
are put together from the cache with numpy. The cache belongs to a Python worker
and is bounded: above ``CACHE_WORDS`` words or ``CACHE_CHARS`` characters it starts anew.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CACHE_WORDS = 600_000
CACHE_CHARS = 16 << 20
JOINED = 2_000  # words encoded in one call

# A plain word: Latin-1 letters and punctuation after them. Lower-casing and
# splitting these by hand gives what the tokenizer's own rules give.
_SPLIT = re.compile(r"(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:%&*$#|]*)|([^ ]*)) ")
_STOPS = (".", "!", "?", "\n")

_ENCODERS: dict[str, WordEncoder] = {}


class _Index(dict):
    """key -> number; unknown keys get the next number and wait in ``new``."""

    def __init__(self):
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        self.chars += len(key)
        return n


def _grow(a: np.ndarray, n: int) -> np.ndarray:
    while len(a) < n:
        a = np.concatenate([a, np.zeros_like(a)])
    return a


class WordEncoder:
    """A word is two runs of ids, its letters and the punctuation after them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task, and one thread's memory
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits: the vocabulary has more than 65,536 pieces")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for piece, i in self.tokenizer.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        self.reset()

    def reset(self) -> None:
        self.words, self.runs = _Index(), _Index()
        self.flat, self.used = np.zeros(1 << 16, np.uint16), 0
        self.offset, self.length = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.parts, self.stops = np.zeros((1 << 14, 2), np.int32), np.zeros(1 << 14, bool)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, first: int, ids: np.ndarray, lens: np.ndarray) -> None:
        n = first + len(lens)
        self.offset, self.length = _grow(self.offset, n), _grow(self.length, n)
        self.flat = _grow(self.flat, self.used + len(ids))
        self.flat[self.used:self.used + len(ids)] = ids
        self.length[first:n] = lens
        self.offset[first:n] = self.used + np.cumsum(lens) - lens
        self.used += len(ids)

    def _learn_runs(self) -> None:
        new, self.runs.new = self.runs.new, []
        first = len(self.runs) - len(new)
        for k in range(0, len(new), JOINED):
            part = new[k:k + JOINED]
            ids = np.array(self._encode([" ".join(part)])[0], np.int64)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            # runs of letters end with a word piece; others are told apart one by one
            if len(cuts) != len(part) or not all(map(str.isalpha, part)):
                each = self._encode(part)
                ids = np.array([i for e in each for i in e], np.int64)
                cuts = np.cumsum([len(e) for e in each])
            self._store(first + k, ids, np.diff(cuts, prepend=0))

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        first, n = len(self.words) - len(new), len(self.words)
        # odd words first, so that most calls see letters only
        split = _SPLIT.findall(" ".join(new) + " ")
        run = self.runs.__getitem__
        tails = [run(t) for _, t, _ in split]
        odd = [run(o) for _, _, o in split]
        self._learn_runs()
        heads = [run(b.lower()) if b else o for (b, _, _), o in zip(split, odd, strict=True)]
        self._learn_runs()
        self.parts, self.stops = _grow(self.parts, n), _grow(self.stops, n)
        self.parts[first:n, 0], self.parts[first:n, 1] = heads, tails
        self.stops[first:n] = [w.endswith(_STOPS) for w in new]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids of all texts in a row, ids per text, words per text, and per word its id
        count and whether a sentence ends with it."""
        if len(self.words) > CACHE_WORDS or self.words.chars > CACHE_CHARS:
            self.reset()
        per_text, found = np.zeros(len(texts), np.int64), []
        get = self.words.__getitem__
        for i, t in enumerate(texts):
            w = t.replace("\n", " \n ").split(" ")
            per_text[i] = len(w)
            found.append(np.fromiter(map(get, w), np.int32, len(w)))
        at = np.concatenate(found) if found else np.zeros(0, np.int32)
        if self.words.new:
            self._learn()
        run = self.parts[at].reshape(-1)
        lens = self.length[run]
        ends = np.cumsum(lens, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat((self.offset[run] - (ends - lens)), lens) + np.arange(total)]
        up_to = np.concatenate([[0], ends[1::2]])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(up_to), per_text, lens.reshape(-1, 2).sum(1, dtype=np.int64), self.stops[at]


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def chunks(batches, id_col: int, text_col: int, size: int = 1 << 21) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of Arrow batches in pieces of about ``size`` characters; null text is empty."""
    ids, texts, n = [], [], 0
    for b in batches:
        for i, t in zip(b.column(id_col).to_pylist(), b.column(text_col).to_pylist(), strict=True):
            t = t or ""
            ids.append(i)
            texts.append(t)
            n += len(t)
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def id_runs(ids: np.ndarray, marks: np.ndarray) -> pa.Array:
    """Binary array of the runs of ``ids`` between marks, as little-endian unsigned 32-bit
    integers. (Made from one buffer: an array of memoryviews would never let go of them.)"""
    raw = np.ascontiguousarray(ids[int(marks[0]):int(marks[-1])], "<u4")
    at = (4 * (marks - marks[0])).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(marks) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
