"""Order-preserving packing of documents into token sequences.

Documents are laid out in ascending ``doc_id`` and cut into windows of at most
``width`` ids. Cuts may fall at document ends, at sentence ends (a word ending in
``. ! ?`` or a line end) and, inside a sentence longer than STEP ids, at every
STEP-th id. The cuts minimise ids of padding plus a penalty for every cut that
truncates a document:

    f(j) = penalty(j) + width - pos(j) + min { f(i) + pos(i) : pos(j) - pos(i) <= width }

The minimum runs over a sliding range, so a monotone queue of candidates gives
each f(j) in constant amortised time.

Scale: one range shuffle by ``doc_id``; each partition packs its own range, in
spans of SPAN ids with the open window carried over, so memory is bounded by the
span and the longest single document. Padding that the plan cannot avoid is one
open window a partition.

Edge cases: null and empty texts are one end id; a text of any length is cut over
as many windows as it needs; repeated rows and equal or null doc_ids are packed
one by one, each with its own pieces; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.tokens import chunks, encoder, id_runs

WIDTH = 4096
SENTENCE_PENALTY = 32
WORD_PENALTY = 256
STEP = 256
SPAN = 1 << 20

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def choose_cuts(pos: np.ndarray, penalty: np.ndarray, width: int) -> list[int]:
    """Positions of the best cuts. ``pos``: ascending candidates, the first 0, gaps of
    at most ``width``; ``penalty``: of a cut at each. The last position is always cut."""
    p, pen = pos.tolist(), penalty.tolist()
    back = [0] * len(p)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (f + pos, pos, candidate), ascending
    for j in range(1, len(p)):
        at = p[j]
        while queue[0][1] < at - width:
            queue.popleft()
        best, _, back[j] = queue[0]
        value = pen[j] + width + best  # f(j) + pos(j)
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, at, j))
    cuts, j = [], len(p) - 1
    while j > 0:
        cuts.append(p[j])
        j = back[j]
    return [0, *reversed(cuts)]


def candidates(lens: np.ndarray, stops: np.ndarray, doc_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions inside one layout and their penalties, without position 0."""
    word_ends = np.cumsum(lens)
    sentence = np.unique(np.concatenate([word_ends[stops], doc_ends]))
    before = np.concatenate([[0], sentence[:-1]])
    extra = [np.arange(a + STEP, b, STEP) for a, b in zip(before, sentence, strict=True) if b - a > STEP]
    pos = np.concatenate([sentence, *extra]) if extra else sentence
    pen = np.concatenate([np.full(len(sentence), SENTENCE_PENALTY), np.full(len(pos) - len(sentence), WORD_PENALTY)])
    order = np.argsort(pos, kind="stable")
    pos, pen = pos[order], pen[order]
    pen[np.searchsorted(pos, doc_ends)] = 0
    keep = (pos > 0) & (pos <= total)
    return pos[keep], pen[keep]


class Packer:
    """Packs one ordered run of documents; ``add`` yields finished pieces, ``close`` the rest."""

    def __init__(self, width: int):
        self.width = width
        self.sequence = 0
        self.ids = np.zeros(0, np.uint32)
        self.pos, self.pen = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc_ids: list = []
        self.doc_at = np.zeros(0, np.int64)  # where each document (or its rest) begins in ids
        self.doc_from = np.zeros(0, np.int64)  # ids of it that went before
        self.doc_tokens = np.zeros(0, np.int64)

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray, pos: np.ndarray, pen: np.ndarray):
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.pos, self.pen = np.concatenate([self.pos, pos + base]), np.concatenate([self.pen, pen])
        self.doc_ids += doc_ids
        self.doc_at = np.concatenate([self.doc_at, base + np.cumsum(sizes) - sizes])
        self.doc_from = np.concatenate([self.doc_from, np.zeros(len(sizes), np.int64)])
        self.doc_tokens = np.concatenate([self.doc_tokens, sizes])
        if len(self.ids) >= SPAN:
            yield self._cut(last=False)

    def close(self):
        if len(self.ids):
            yield self._cut(last=True)

    def _cut(self, last: bool) -> dict:
        cuts = choose_cuts(np.concatenate([[0], self.pos]), np.concatenate([[0], self.pen]), self.width)
        if not last:
            cuts.pop()  # the open window goes on with the next documents
        cut = np.array(cuts)
        end = int(cut[-1])
        marks = np.unique(np.concatenate([self.doc_at[self.doc_at < end], cut]))
        at, size = marks[:-1], np.diff(marks)
        doc = np.searchsorted(self.doc_at, at, "right") - 1
        seq = np.searchsorted(cut, at, "right") - 1
        out = {
            "doc_id": [self.doc_ids[i] for i in doc.tolist()],
            "start": self.doc_from[doc] + at - self.doc_at[doc],
            "length": size,
            "doc_tokens": self.doc_tokens[doc],
            "sequence_id": self.sequence + seq,
            "offset": at - cut[seq],
            "ids": id_runs(self.ids, marks),
        }
        self.sequence += len(cut) - 1
        first = int(np.searchsorted(self.doc_at, end, "right") - 1) if end < len(self.ids) else len(self.doc_ids)
        self.doc_ids = self.doc_ids[first:]
        at, self.doc_tokens = self.doc_at[first:], self.doc_tokens[first:]
        gone = np.maximum(end - at, 0)
        self.doc_from = self.doc_from[first:] + gone
        self.doc_at = at + gone - end
        self.ids = self.ids[end:].copy()
        keep = self.pos > end
        self.pos, self.pen = self.pos[keep] - end, self.pen[keep]
        return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, width: int = WIDTH) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset
    and the piece's ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        part = TaskContext.get().partitionId() << 33
        packer, enc = Packer(width), encoder(tokenizer)

        def table(cols: dict) -> pa.RecordBatch:
            ints = {k: pa.array(cols[k], pa.int64()) for k in ("doc_id", "start", "length", "doc_tokens")}
            return pa.RecordBatch.from_pydict(ints | {
                "sequence_id": pa.array(cols["sequence_id"] + part, pa.int64()),
                "offset": pa.array(cols["offset"], pa.int64()), "ids": cols["ids"]})

        for doc_ids, texts in chunks(batches, 0, 1):
            ids, sizes, n_words, lens, stops = enc.encode(texts)
            with_end = np.insert(ids.astype(np.uint32), np.cumsum(sizes), end_id)
            last = np.cumsum(n_words)  # the end id is a word of its own after each document
            words, marks = np.insert(lens, last, 1), np.insert(stops, last, False)
            doc_ends = np.cumsum(sizes + 1)
            pos, pen = candidates(words, marks, doc_ends, len(with_end))
            for out in packer.add(doc_ids, with_end, sizes + 1, pos, pen):
                yield table(out)
        for out in packer.close():
            yield table(out)

    # equal or missing ids are told apart by their texts, so that no id fills one task
    ordered = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"),
                           F.xxhash64(docs["text"]).alias("h"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text"))
    return ordered.mapInArrow(run, SCHEMA)
