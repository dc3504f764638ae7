"""Adaptive context-mixing arithmetic coder for token ids, many blocks at a time.

A block of ids is coded on its own: all models start empty, and a crc32 of its ids
is kept beside it. Blocks do not depend on each other, so the coder runs them as
lanes of numpy arrays, one id of every block a step.

Model of one id, after the two ids before it:

* order 2 and order 1: a hashed table holds the id that last followed each context and
  how often that was right (0 to 3). The prediction of the longest context that has
  been seen is tried first. The probability that it is right mixes two adaptive
  estimates, by the counts of both orders and by the outcomes of the last ids
  (order 0), with a weight that each block learns.
* order 0: a wrong prediction is followed by the id itself. A table of SLOTS recent ids,
  each in the slot of its hash, has a frequency a slot; the id is coded as its slot by
  these adaptive frequencies, or, where its slot holds another id, as 16 bits. Which
  of the two has an adaptive probability by the last outcomes. Cumulative
  frequencies are made anew at the steps of ``_renews``.

So an id is two decisions: one of prediction, slot or 16 bits, and one that names the slot
or the bits. Each narrows the interval of an arithmetic coder (64-bit arithmetic, 16
bits out at a time, carries passed back into the words already out). Everything is integer
arithmetic and table lookups, so encoder and decoder agree on any machine.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
CONTEXTS = 2048  # hashed contexts an order
SLOTS = 512  # searched as 8 groups of 8 groups of 8
SCALE = 15  # bits of a probability
TOTAL = 1 << SCALE
LEAST = 8  # of TOTAL, for every slot
EDGE = 256  # of TOTAL, for either outcome of a decision
RATE = 4
RENEW = 128  # ids between two makings of the cumulative frequencies, after the first few
HIT, KNOWN, RAW = 0, 1, 2

_ONE, _WORD, _S = np.uint64(1), np.uint64(16), np.uint64(SCALE)
_LOW, _HIGH = np.uint64(40), np.uint64(56)  # the range lies between these powers of two
_LAST, _MOST = np.uint64(TOTAL - 1), np.uint64(0xFFFF)
_NARROW, _MASK, _TOP = _ONE << _LOW, (_ONE << _LOW) - _ONE, (_ONE << _HIGH) - _ONE


def _renews(step: int) -> bool:
    return step % RENEW == 0 or step in (8, 16, 32, 64)


class _Model:
    """State of L blocks. All methods work on the first ``n`` of them."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int64)
        self.contexts, self.slots = lane * CONTEXTS, lane * SLOTS
        self.marks, self.few, self.tops, self.middles = lane * 32, lane * 4, lane * 8, lane * 64
        self.one, self.two = np.zeros(lanes * CONTEXTS, np.int32), np.zeros(lanes * CONTEXTS, np.int32)
        self.by_counts = np.full(lanes * 32, TOTAL // 4, np.int32)
        self.by_last = np.full(lanes * 4, TOTAL // 4, np.int32)
        self.known = np.full(lanes * 4, TOTAL // 2, np.int32)
        self.weight = np.full(lanes, 192, np.int32)  # of by_counts, in 256ths
        self.last_hits, self.last_known = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.ids = np.full(lanes * SLOTS, -1, np.int32)
        self.seen = np.zeros((lanes, SLOTS), np.int32)
        self.wide = np.full((lanes, SLOTS), TOTAL // SLOTS, np.uint16)  # frequency of each slot
        self.below = np.tile(np.arange(SLOTS, dtype=np.uint16) * (TOTAL // SLOTS), (lanes, 1))  # and of those before it
        self._groups()
        self.a, self.b = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)

    def _groups(self) -> None:
        """Rows of 8 cumulative frequencies: of all slots, of every 8th and of every 64th."""
        self.fine = self.below.view("V16").reshape(-1)
        self.middle = np.ascontiguousarray(self.below[:, ::8]).view("V16").reshape(-1)
        self.top = np.ascontiguousarray(self.below[:, ::64]).view("V16").reshape(-1)

    def predict(self, n: int) -> None:
        """Set the id tried, the probability that it is right and, if not, that the slot has it."""
        x = self.b[:n] * np.int32(40503)  # wraps, the same way everywhere
        self.s1 = (x >> 4 & (CONTEXTS - 1)) + self.contexts[:n]
        x += self.a[:n] * np.int32(48271)
        self.s2 = (x >> 6 & (CONTEXTS - 1)) + self.contexts[:n]
        v1, v2 = self.one.take(self.s1), self.two.take(self.s2)
        self.v1, self.v2 = v1, v2
        n1, n2 = v1 >> 16, v2 >> 16
        self.tried = np.where(n2, v2, v1) & 0xFFFF
        n2 *= 4
        n2 += n1
        n2 *= 2
        n2 += ((v1 ^ v2) & 0xFFFF) == 0
        self.at_counts = n2 + self.marks[:n]
        self.at_last = self.last_hits[:n] + self.few[:n]
        self.at_known = self.last_known[:n] + self.few[:n]
        self.p_counts, self.p_last = self.by_counts.take(self.at_counts), self.by_last.take(self.at_last)
        self.p_known = self.known.take(self.at_known)
        self.apart = self.p_counts - self.p_last
        # where the three outcomes begin: 0, first, second
        self.first = self.p_last + (self.apart * self.weight[:n] >> 8)
        self.second = self.first + ((TOTAL - self.first) * self.p_known >> SCALE)

    def learn(self, n: int, s, hit, slot, known) -> None:
        """``known``: the slot holds the id, whether or not the prediction was right."""
        goal = hit * np.int32(TOTAL - 2 * EDGE)
        goal += EDGE
        self.by_counts[self.at_counts] = self.p_counts + ((goal - self.p_counts) >> RATE)
        self.by_last[self.at_last] = self.p_last + ((goal - self.p_last) >> RATE)
        # the weight follows the estimate that was nearer
        w = self.weight[:n]
        w += ((goal - self.first) >> 8) * (self.apart >> 8) >> 8
        np.minimum(w, 256, out=w)
        np.maximum(w, 0, out=w)
        last = self.last_hits[:n]
        last *= 2
        last += hit
        last &= 3
        goal = known * np.int32(TOTAL - 2 * EDGE)
        goal += EDGE
        self.known[self.at_known] = self.p_known + ((goal - self.p_known) >> RATE)
        last = self.last_known[:n]
        last *= 2
        last += known
        last &= 3
        seen = self.seen.reshape(-1)
        seen[slot] = np.where(known, seen.take(slot) + 2, 3)
        self.ids[slot] = s
        fresh = s + np.int32(1 << 16)
        most = s + np.int32(3 << 16)
        for table, at, v in ((self.one, self.s1, self.v1), (self.two, self.s2, self.v2)):
            table[at] = np.where((v & 0xFFFF) == s, np.minimum(v + np.int32(1 << 16), most), fresh)
        self.a[:n] = self.b[:n]
        self.b[:n] = s

    def slot_of(self, n: int, s):
        return (s * np.int32(40503) >> 3 & (SLOTS - 1)) + self.slots[:n]

    def renew(self) -> None:
        """Cumulative frequencies from what has been seen; a slot is never without some."""
        total = np.cumsum(self.seen, axis=1, dtype=np.int32)
        share = ((TOTAL - SLOTS * LEAST) << 10) // np.maximum(total[:, -1:], 1)
        total *= share.astype(np.int32)
        total >>= 10
        total += np.arange(1, SLOTS + 1, dtype=np.int32) * LEAST
        total[:, -1] = TOTAL
        self.below[:, 1:] = total[:, :-1]
        np.subtract(total, self.below, out=self.wide, casting="unsafe")
        self._groups()

    def find(self, n: int, t):
        """The slot (from 0) that each of the probabilities ``t`` (64-bit) falls in."""
        t = t * _EACH | _SIGNS
        spot = _inside(self.top[:n], t)
        spot = spot * 8 + _inside(self.middle.take(spot + self.tops[:n]), t)
        return spot * 8 + _inside(self.fine.take(spot + self.middles[:n]), t)


# four 16-bit numbers in 64 bits: one, and the sign, of each
_EACH, _SIGNS = np.uint64(0x0001000100010001), np.uint64(0x8000800080008000)


def _inside(rows, t):
    """Which of the 8 cumulative frequencies of a row is the last that is not above t: a sign is
    left for each that is not, by subtracting four at a time."""
    four = rows.view(np.uint64).reshape(-1, 2)
    left = (t - four[:, 0]) & _SIGNS
    left >>= _ONE
    left |= (t - four[:, 1]) & _SIGNS
    return np.bitwise_count(left) - np.int64(1)


class _Writer:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, _TOP)
        self.out, self.used = np.zeros((lanes, BLOCK + 64), np.uint16), np.zeros(lanes, np.int64)
        self.full = 0  # no lane has more words than this

    def _room(self, more: int) -> None:
        self.full += more
        if self.full >= self.out.shape[1]:
            self.full = int(self.used.max(initial=0)) + more
            if self.full >= self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros_like(self.out)], 1)

    def _carry(self, n: int) -> None:
        lanes = np.flatnonzero(self.low[:n] > _TOP)
        if len(lanes):
            self.low[lanes] &= _TOP
            at = self.used[lanes] - 1
            while len(lanes):
                word = self.out[lanes, at] + np.uint16(1)
                self.out[lanes, at] = word
                on = np.flatnonzero(word == 0)
                lanes, at = lanes[on], at[on] - 1

    def settle(self, n: int) -> None:
        """Pass carries on and put out the words that are settled; a step needs two at most."""
        self._carry(n)
        lanes = np.flatnonzero(self.range[:n] < _NARROW)
        self._room(2)
        while len(lanes):
            low, r = self.low[lanes], self.range[lanes] << _WORD
            self.out[lanes, self.used[lanes]] = low >> _LOW
            self.used[lanes] += 1
            self.low[lanes], self.range[lanes] = (low & _MASK) << _WORD, r
            lanes = lanes[r < _NARROW]

    def close(self, n: int) -> None:
        """Two more words name a point inside the interval, as zeros follow them."""
        self._room(2)
        self.low += _NARROW >> _WORD
        self._carry(n)
        at = np.arange(n)
        for shift in (_LOW, _LOW - _WORD):
            self.out[at, self.used] = (self.low >> shift) & np.uint64(0xFFFF)
            self.used += 1


class _Reader:
    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        lanes = len(sizes)
        self.range = np.full(lanes, _TOP)
        self.words = np.zeros((lanes, int(sizes.max(initial=0)) + 8), np.uint16)
        self.words[np.arange(self.words.shape[1]) < sizes[:, None]] = words
        x = self.words[:, :4].astype(np.uint64)
        # what the first 56 bits say, above the interval's lower end
        self.x = x[:, 0] << _LOW | x[:, 1] << (_LOW - _WORD) | x[:, 2] << np.uint64(8) | x[:, 3] >> np.uint64(8)
        self.rest = x[:, 3] & np.uint64(0xFF)
        self.used = np.full(lanes, 4, np.int64)

    def settle(self, n: int) -> None:
        lanes = np.flatnonzero(self.range[:n] < _NARROW)
        while len(lanes):
            at = np.minimum(self.used[lanes], self.words.shape[1] - 1)  # the last words are zeros
            word = self.words[lanes, at].astype(np.uint64)
            # the reader is half a word ahead
            self.x[lanes] = self.x[lanes] << _WORD | self.rest[lanes] << np.uint64(8) | word >> np.uint64(8)
            self.rest[lanes] = word & np.uint64(0xFF)
            self.used[lanes] += 1
            r = self.range[lanes] << _WORD
            self.range[lanes] = r
            lanes = lanes[r < _NARROW]


def _outcome(model: _Model, hit, known):
    """Where the outcome of each lane begins and ends."""
    begin = np.where(known, model.first, model.second)
    begin[hit] = 0
    end = np.where(known, model.second, np.int32(TOTAL))
    return begin, np.where(hit, model.first, end)


def _encode_step(model: _Model, out: _Writer, n: int, s) -> None:
    model.predict(n)
    hit, slot = model.tried == s, model.slot_of(n, s)
    known = model.ids.take(slot) == s
    low, r = out.low[:n], out.range[:n] >> _S
    begin, end = _outcome(model, hit, known)
    low += r * begin.astype(np.uint64)
    r *= (end - begin).astype(np.uint64)
    start = np.where(known, model.below.reshape(-1).take(slot), s).astype(np.uint64)
    wide = np.where(known, model.wide.reshape(-1).take(slot), 1).astype(np.uint64)
    part = r >> (_WORD - known)  # 16 bits, or 15 of a slot
    part[hit] = 0  # nothing is left to say
    low += part * start
    out.range[:n] = np.where(hit, r, part * wide)
    out.settle(n)
    model.learn(n, s, hit, slot, known)


def _decode_step(model: _Model, code: _Reader, n: int):
    model.predict(n)
    x, r = code.x[:n], code.range[:n] >> _S
    t = (x // r).astype(np.int32)
    hit, named = t < model.first, t < model.second
    begin, end = _outcome(model, hit, named)
    x -= r * begin.astype(np.uint64)
    r *= (end - begin).astype(np.uint64)
    part = r >> (_WORD - named)
    t = x // part
    at = model.find(n, np.minimum(t, _LAST)) + model.slots[:n]
    s = np.where(hit, model.tried, np.where(named, model.ids.take(at), np.minimum(t, _MOST).astype(np.int32)))
    start = np.where(named, model.below.reshape(-1).take(at), s).astype(np.uint64)
    wide = np.where(named, model.wide.reshape(-1).take(at), 1).astype(np.uint64)
    part[hit] = 0
    x -= part * start
    code.range[:n] = np.where(hit, r, part * wide)
    code.settle(n)
    slot = model.slot_of(n, s)
    model.learn(n, s, hit, slot, model.ids.take(slot) == s)
    return s


def _lanes(count: int) -> tuple[int, int]:
    """Blocks of a run of ids and the length of the last."""
    lanes = -(-count // BLOCK)
    return lanes, count - (lanes - 1) * BLOCK


def _steps(lanes: int, last: int):
    """(step, blocks that have an id there)."""
    for t in range(BLOCK if lanes > 1 else last):
        yield t, lanes if t < last else lanes - 1


def encode(ids: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Payload, 16-bit words of each block, crc32 of each block's ids."""
    if len(ids) and (int(ids.max()) > 0xFFFF or int(ids.min()) < 0):
        raise ValueError("ids must lie between 0 and 65535")
    lanes, last = _lanes(len(ids))
    if not lanes:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    grid = np.zeros((lanes, BLOCK), np.uint16)
    grid.reshape(-1)[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.T)
    model, out = _Model(lanes), _Writer(lanes)
    for t, n in _steps(lanes, last):
        if t and _renews(t):
            model.renew()
        _encode_step(model, out, n, grid[t, :n].astype(np.int32))
    out.close(lanes)
    raw = np.asarray(ids).astype("<u4").tobytes()
    crcs = np.array([zlib.crc32(raw[k:k + 4 * BLOCK]) for k in range(0, len(raw), 4 * BLOCK)], np.int64)
    inside = np.arange(out.out.shape[1]) < out.used[:, None]
    return out.out[inside].astype("<u2").tobytes(), out.used, crcs


def decode(payload: bytes, sizes: np.ndarray, crcs: np.ndarray, count: int) -> np.ndarray:
    """The ids; raises ValueError if a block's checksum differs."""
    lanes, last = _lanes(count)
    if not lanes:
        return np.zeros(0, np.uint32)
    if len(sizes) != lanes or len(payload) != 2 * int(np.sum(sizes)):
        raise ValueError("the record is cut short")
    model, code = _Model(lanes), _Reader(np.frombuffer(payload, "<u2"), np.asarray(sizes))
    grid = np.zeros((BLOCK, lanes), np.uint16)
    for t, n in _steps(lanes, last):
        if t and _renews(t):
            model.renew()
        grid[t, :n] = _decode_step(model, code, n)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:count].astype(np.uint32)
    raw = ids.astype("<u4").tobytes()
    for k, want in enumerate(np.asarray(crcs).tolist()):
        if zlib.crc32(raw[4 * BLOCK * k:4 * BLOCK * (k + 1)]) != want:
            raise ValueError(f"block {k}: wrong checksum")
    return ids
