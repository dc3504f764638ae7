"""Token counts of a unigram tokenizer without making its tokens.

The best split of a word into vocabulary pieces is a shortest path: an
Aho-Corasick automaton names all pieces that end at each character, and dynamic
programming carries the best score, the number of pieces and whether the last one
is unknown. No path is stored and nothing is traced back.

The tie rules are those of the ``tokenizers`` library's Unigram model: where two
paths to a position score the same, the one whose last piece starts earlier stays;
a character that is no piece of its own may be passed as unknown, at the lowest
score of the vocabulary less 10; neighbouring unknowns are one token. Text is split
as its Metaspace step does: white space ``U+0020`` becomes the mark, one mark is put
before a text that does not begin with it, and every mark begins a word.

Edge cases: null and empty texts have 0 tokens; texts of any length are read whole;
repeated rows are counted one by one; an empty table gives an empty result; other
columns are never read. Words are counted once per Python worker and cached, the
cache bounded by CACHE_WORDS and CACHE_CHARS.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from plexus.llm.tokens import chunks

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 800_000
CACHE_CHARS = 16 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, in id order."""

    pieces: tuple[tuple[str, float], ...]


def sentencepiece_vocabulary(path: str) -> Vocabulary:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())))


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}
        self.cached = 0  # characters

    def count_word(self, word: str) -> int:
        n = len(word)
        best, count, open_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # positions up to here have their best path

        def pass_unknown(end: int) -> None:
            s = best[end - 1] + self.unknown
            if best[end] is None or s > best[end]:
                best[end], open_unknown[end] = s, True
                count[end] = count[end - 1] + (not open_unknown[end - 1])

        for i in range(1, n + 1):
            best[i] = None
        single = False
        for last, (size, score) in self.automaton.iter(word):  # by end, longest piece first
            end = last + 1
            while done < end - 1:
                done += 1
                if not single or done != self._at:
                    pass_unknown(done)
                single = False
            self._at = end
            start = end - size
            s = best[start] + score
            if best[end] is None or s > best[end]:
                best[end], count[end], open_unknown[end] = s, count[start] + 1, False
            single = single or size == 1
        while done < n:
            done += 1
            if not single or done != self._at:
                pass_unknown(done)
            single = False
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(" ", MARK).split(MARK)
        if not words[0]:
            words = words[1:]
        if len(self.cache) > CACHE_WORDS or self.cached > CACHE_CHARS:
            self.cache.clear()
            self.cached = 0
        total, cache = 0, self.cache
        for w in words:
            c = cache.get(w)
            if c is None:
                c = cache[w] = self.count_word(MARK + w)
                self.cached += len(w)
            total += c
        return total


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and n_tokens of every row; the vocabulary (a tokenizer file) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.pieces)
    key = hash(vocabulary.pieces)

    def run(batches):
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(Vocabulary(shared.value))
        c = _COUNTERS[key]
        for ids, texts in chunks(batches, 0, 1):
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array([c.count(t) for t in texts], pa.int64())})

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")
